"""Weekly counts that follow signed changes, so that a run reads what is new and not the quarter.

Events are distinct over their keys per tag, so a row that arrives again must not count twice and
taking back one of two equal rows must not remove the event. An open week therefore keeps, per
event, its support: the number of rows behind it. An event counts while its support is positive.
Support is a sum, so inserts, late rows and reversals may arrive in any order and split over any
runs, and the counts come out as if all rows had been counted at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalweave.config import TagRule
from fiscalweave.functions.calendar import FiscalRule
from fiscalweave.operators import events as ev

WEEK = ("fy", "qtr", "fweek")
CELL = (*WEEK, "team", "table_type")


def event_changes(changes: DataFrame, agents: DataFrame, rule: FiscalRule,
                  rules: Sequence[TagRule], fy: int, qtr: int | None = None,
                  teams: Sequence[str] | None = None, excluded_firms: Sequence = (),
                  change: str = "change") -> DataFrame:
    """(cell, event, change): what changed rows add to the support of tagged events.

    ``changes`` are bookings with a whole number in ``change``: 1 for a row that is new, -1 for one
    that is taken back. Tagging, calendar and dimension are those of ``events.weekly_events``; the
    event is a 128-bit fingerprint of its keys, null unlike any value. Rows without a week, or that
    cancel out within the batch, are gone. Shuffled once, after a map-side combine.
    """
    fact = ev.in_period(changes, "event_date", rule, fy, qtr)
    if teams is not None:
        fact = ev.filter_allowlist(fact, "team_raw", teams)
    fact = fact.filter(ev.any_rule(rules, excluded_firms))
    masks = ev.tag_masks(rules, excluded_firms)
    fact = ev.join_calendar(fact.withColumns(masks), ev.period_calendar(fact, rule, fy, qtr), fy, qtr)
    fact = ev.explode_masks(ev.join_scd_current(fact, agents), rules)
    parts = [F.coalesce(F.concat(F.length(F.col(k).cast("string")).cast("string"), F.lit(":"),
                                 F.col(k).cast("string")), F.lit("-")) for k in ev.EVENT_KEYS]
    return (fact.filter(F.col("week").isNotNull())
            .select("fy", "qtr", F.col("week").alias("fweek"),
                    F.coalesce("team_raw", F.lit("")).alias("team"), "table_type",
                    F.unhex(F.md5(F.concat(*parts))).alias("event"),
                    F.col(change).cast("long").alias("change"))
            .groupBy(*CELL, "event").agg(F.sum("change").alias("change"))
            .filter(F.col("change") != 0))


def fold(support: DataFrame, changes: DataFrame) -> DataFrame:
    """(cell, event, before, after) of every event of the given support and changes.

    One shuffle: both sides are stacked and summed, which needs no join and combines early. An
    event may stand below zero while its reversal has come before its insert.
    """
    old = support.select(*CELL, "event", F.col("support").alias("before"),
                         F.col("support").alias("after"))
    new = changes.select(*CELL, "event", F.lit(0).cast("long").alias("before"),
                         F.col("change").alias("after"))
    return (old.unionByName(new).groupBy(*CELL, "event")
            .agg(F.sum("before").alias("before"), F.sum("after").alias("after")))


def new_support(folded: DataFrame) -> DataFrame:
    return (folded.filter(F.col("after") != 0)
            .select(*CELL, "event", F.col("after").alias("support")))


def cell_deltas(folded: DataFrame) -> DataFrame:
    """(cell, n): by how much the count of each cell changes; cells that keep theirs are left out."""
    step = (F.col("after") > 0).cast("long") - (F.col("before") > 0).cast("long")
    return (folded.filter(step != 0).groupBy(*CELL).agg(F.sum(step).alias("n"))
            .filter(F.col("n") != 0))


def add_deltas(cells: DataFrame, deltas: DataFrame) -> DataFrame:
    """(cell, n) after the deltas; a cell that has come to nothing is left out."""
    both = cells.select(*CELL, "n").unionByName(deltas.select(*CELL, "n"))
    return both.groupBy(*CELL).agg(F.sum("n").alias("n")).filter(F.col("n") != 0)
