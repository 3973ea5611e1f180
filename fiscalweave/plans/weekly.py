"""The weekly run: extract and tag, classify and freeze, publish, summarise.

The driver only builds plans and starts writes. Whatever a later step needs again is read back from
the table an earlier step wrote, so no fact is computed twice and losing executors costs no more
than their tasks.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalweave.config import CancelRules, OwnerRules, RegionRules, TagRule
from fiscalweave.functions.calendar import FiscalRule
from fiscalweave.operators import calendar as cal
from fiscalweave.operators import counts as cnt
from fiscalweave.operators import events as ev
from fiscalweave.operators import owners as ow
from fiscalweave.operators import report as rp
from fiscalweave.operators.freeze import weekly_freeze
from fiscalweave.schemas import WEEKLY_EVENTS
from fiscalweave.sources import sinks

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class WeeklyInputs:
    """Source tables of one run."""

    bookings: DataFrame
    agents: DataFrame
    account_status: DataFrame
    company_status: DataFrame
    accounts: DataFrame
    owner_history: DataFrame
    users: DataFrame
    roster: DataFrame


@dataclass(frozen=True)
class WeeklyConfig:
    as_of: dt.date
    tags: Sequence[TagRule]
    regions: RegionRules
    teams: Sequence[str]
    excluded_firms: Sequence
    cancels: CancelRules
    owners: OwnerRules
    toplines: Sequence[tuple[str, str]]
    cancel_labels: Sequence[str]
    driver_tag: str = "SALES"
    cancel_tag: str = "CANCELS"
    rule: FiscalRule = FiscalRule()


@dataclass(frozen=True)
class WeeklyTarget:
    """Folders of the published tables."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def version(self, spark: SparkSession) -> int:
        """The number of the last commit; 0 before the first run."""
        return sinks.run_log(spark, self.path("run_meta")).head()

    def run_meta(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """All runs committed up to a version; empty before the first one."""
        return sinks.run_log(spark, self.path("run_meta")).read(version)

    def read(self, spark: SparkSession, name: str, version: int | None = None) -> DataFrame:
        """A published event table, as a version left it; empty before the first run."""
        reader = sinks.read_freeze if name == "freeze_store" else sinks.read_run
        return reader(spark, self.path(name), self.run_meta(spark, version), WEEKLY_EVENTS)

    def clean(self, spark: SparkSession, keep: int = 1, older_than: float = 7 * 86400) -> list[str]:
        """Delete attempts that no kept run names, see ``sinks.clean_runs``."""
        tables = ("weekly_events", "freeze_store", "calendar_weeks", "cell_counts")
        return sinks.clean_runs(spark, self.path("run_meta"), [self.path(t) for t in tables], keep,
                                older_than)

    def calendar_weeks(self, spark: SparkSession) -> DataFrame:
        """The calendar of the latest run that wrote one."""
        runs = self.run_meta(spark).filter(F.col("attempt").isNotNull())
        stored = spark.read.parquet(self.path("calendar_weeks"))
        live = (runs.join(stored.select("attempt").distinct(), "attempt")
                .agg(F.max_by("attempt", F.struct("version", "finished_at")).alias("a")))
        return stored.filter(F.col("attempt") == live.scalar()).drop("attempt")


def run_week(inputs: WeeklyInputs, config: WeeklyConfig, target: WeeklyTarget, run_id: str,
             finished_at: dt.datetime | None = None) -> DataFrame:
    """Publish the current quarter as of ``config.as_of``; returns row counts per table_type.

    All that a run writes carries the name of this attempt, and one numbered commit publishes it in
    the end. Whatever fails before that leaves readers with the last published state, and the run
    can be repeated. So it does when another run of the quarter has committed since this one read
    the store: the commit then raises ``CommitConflict``. A failing freeze does not stop the run: the cancels are then published as
    queried, and the store stays with the last run that wrote it. Neither does a failing calendar
    or summary.
    """
    spark = inputs.bookings.sparkSession
    fy, qtr, week = config.rule.position(config.as_of)
    attempt, base = sinks.new_attempt(run_id), target.version(spark)

    sales = ev.weekly_events(inputs.bookings, inputs.agents, config.rule, config.tags,
                             config.regions, fy, qtr, config.teams, config.excluded_firms)
    cancels = ow.cancel_events(
        inputs.account_status, inputs.company_status, inputs.accounts, inputs.owner_history,
        inputs.users, inputs.agents, config.rule, config.cancels, config.regions, config.as_of,
        fy, qtr, config.owners.unmanaged)
    cancels = ow.classify_owner(cancels, ow.roster_keys(inputs.roster, config.owners),
                                config.owners)
    scratch = sinks.scratch_path(spark, "cancels")
    cancels.write.parquet(scratch)  # read three times below
    cancels = spark.read.schema(cancels.schema).parquet(scratch)
    try:
        store_attempt = None
        with _tolerated("freeze"):
            store = target.read(spark, "freeze_store", base)
            frozen = weekly_freeze(store, cancels, fy, qtr, week)
            sinks.write_freeze(frozen.store, target.path("freeze_store"), attempt, fy, qtr)
            cancels, store_attempt = frozen.events, attempt
        sinks.write_run(sales.unionByName(cancels), target.path("weekly_events"), attempt, fy,
                        qtr, ["table_type"])
    finally:
        sinks.remove(spark, scratch)
    with _tolerated("calendar"):
        days = cal.date_spine(spark, config.rule.bounds(fy - 1)[0], config.rule.bounds(fy + 1)[1])
        weeks = cal.calendar_weeks(cal.fiscal_calendar(days, config.rule), fy - 1, fy + 1)
        weeks.coalesce(1).write.parquet(target.path(f"calendar_weeks/attempt={attempt}"))

    schema = T.StructType([*WEEKLY_EVENTS.fields, T.StructField("attempt", T.StringType())])
    published = (spark.read.schema(schema).parquet(target.path("weekly_events"))
                 .filter((F.col("fy") == fy) & (F.col("qtr") == qtr)
                         & (F.col("attempt") == attempt)))
    cells_path = target.path(f"cell_counts/attempt={attempt}")
    cnt.cell_counts(published).write.parquet(cells_path)
    cells = spark.read.parquet(cells_path)
    text = ""
    with _tolerated("summary"):
        text = summary_text(cells, config)
    sinks.append_run_meta(spark, target.path("run_meta"), run_id, fy, qtr,
                          finished_at or dt.datetime.now(dt.timezone.utc), text, attempt,
                          store_attempt, base)
    return cells.groupBy("table_type").agg(F.sum("n").alias("n"))


@contextlib.contextmanager
def _tolerated(step: str):
    """A step that may fail without stopping the run."""
    try:
        yield
    except Exception as error:  # noqa: BLE001 - by design
        log.warning("%s skipped: %s", step, error)


def summary_text(cells: DataFrame, config: WeeklyConfig) -> str:
    """The fact lines of a run as one text; a few dozen lines by construction."""
    series = cells.groupBy("table_type", "fy", "qtr", "fweek").agg(F.sum("n").alias("n"))
    labelled = cells.withColumnRenamed("team", "label")
    facts = rp.narrative_facts(
        series, labelled.filter(F.col("table_type") == config.driver_tag),
        labelled.filter(F.col("table_type") == config.cancel_tag), config.driver_tag,
        config.cancel_tag, config.toplines, config.teams, config.cancel_labels)
    text = facts.agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("fy", "qtr", "block", "line_no", "fact"))),
        lambda x: x["fact"]), "\n").alias("text"))
    return text.first().text
