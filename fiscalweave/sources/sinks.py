"""Snapshots, the freeze store, run metadata and text exports.

Every writer goes to a new location or to partitions of an attempt of its own. One numbered commit
(see ``commits``) makes it visible, so a job that dies half way never changes what readers see,
repeating a run never touches the files that it reads, and of two runs that start from one state
only one is published.
"""

from __future__ import annotations

import datetime as dt
import json
import tempfile
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalweave.schemas import RUN_META
from fiscalweave.sources.commits import (CommitLog, exists, folders, newest, remove,
                                         remove_dead_attempts)

_own: dict[str, tempfile.TemporaryDirectory] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, as the session names it.

    Only a local session without one (a test) gets a folder of its own, which goes when Python
    ends; on a cluster a folder of one machine would be useless to the others. The session's
    settings stay as they are.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _own:
        _own[app] = tempfile.TemporaryDirectory(prefix="fiscalweave-", ignore_cleanup_errors=True)
    return _own[app].name


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def rewritten(df: DataFrame, name: str) -> DataFrame:
    """The frame as a written table, for several readers; its lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# -- snapshots -----------------------------------------------------------------------------------

SNAPSHOT = T.StructType([T.StructField("folder", T.StringType()),
                         T.StructField("schema", T.StringType())])


def snapshot_log(spark: SparkSession, target: str) -> CommitLog:
    return CommitLog(spark, f"{target.rstrip('/')}/_commits", SNAPSHOT, ("folder",))


def write_snapshot(df: DataFrame, target: str, partition_by: Sequence[str] = ()) -> int:
    """Full-refresh replacement of ``target``, created when absent; returns its new version.

    The rows go to a folder of their own below ``target``; a numbered commit then points readers
    to it in one step. A write that dies half way leaves the old table as it was, ``df`` may read
    the table that it replaces, and of two writers the later commit is what readers see.
    """
    spark, folder = df.sparkSession, f"data-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(f"{target.rstrip('/')}/{folder}")
    return snapshot_log(spark, target).commit(
        spark.createDataFrame([(folder, df.schema.json())], SNAPSHOT))


def read_snapshot(spark: SparkSession, target: str, version: int | None = None) -> DataFrame:
    """The rows of a snapshot as of its last commit, or of an earlier one that is still kept."""
    log = snapshot_log(spark, target)
    at = log.head() if version is None else version
    live = log.read().filter(F.col("version") == at).first()
    if live is None:
        raise ValueError(f"{target} has no snapshot" + (f" of version {at}" if at else ""))
    schema = T.StructType.fromJson(json.loads(live.schema))
    return (spark.read.schema(schema).parquet(f"{target.rstrip('/')}/{live.folder}")
            .select(*schema.names))


def clean_snapshot(spark: SparkSession, target: str, keep: int = 2,
                   older_than: float = 7 * 86400) -> list[str]:
    """Delete the folders of all but the last ``keep`` versions, and of writes that never came to a
    commit, if nothing was written to them for ``older_than`` seconds; returns their names."""
    log = snapshot_log(spark, target)
    head = log.head()
    live = {r.folder for r in log.read().filter(F.col("version") > head - keep).collect()}
    before = time.time() - older_than
    gone = [n for n in folders(spark, target) if n.startswith("data-") and n not in live
            and newest(spark, f"{target}/{n}") <= before]
    for name in gone:
        remove(spark, f"{target}/{name}")
    return gone


# -- runs ----------------------------------------------------------------------------------------


def run_log(spark: SparkSession, target: str) -> CommitLog:
    """The log of completed runs; runs of one fiscal quarter depend on each other."""
    return CommitLog(spark, target, RUN_META, ("fy", "qtr"))


def append_run_meta(spark: SparkSession, target: str, run_id: str, fy: int, qtr: int,
                    finished_at: dt.datetime, summary_text: str = "", attempt: str | None = None,
                    store_attempt: str | None = None, base: int | None = None) -> int:
    """Record that a run has completed; returns the number of the commit. It makes the event
    partitions of ``attempt`` visible (the run id where none is given) and, if the run wrote the
    freeze store, moves the store to ``store_attempt``. Naive times count as UTC.

    ``base`` is the version whose state the run has read. If another run has committed the same
    quarter since, ``CommitConflict`` is raised, nothing becomes visible, and the run can be
    repeated on the new state. Without a base the run is taken not to depend on any.
    """
    if finished_at.tzinfo is None:
        finished_at = finished_at.replace(tzinfo=dt.timezone.utc)
    row = [(run_id, fy, qtr, finished_at, summary_text, attempt or run_id, store_attempt)]
    return run_log(spark, target).commit(spark.createDataFrame(row, RUN_META), base)


def latest_run(run_meta: DataFrame, pointer: str = "attempt") -> DataFrame:
    """The last committed run per fiscal quarter, of those that moved ``pointer``.

    Commits count by their number, rows of one commit by the time the run finished.
    """
    order = F.struct(*[c for c in ("version", "finished_at", "run_id", "attempt")
                       if c in run_meta.columns])
    found = F.struct("run_id", "finished_at", "summary_text", "attempt", "store_attempt")
    return (run_meta.filter(F.col(pointer).isNotNull()).groupBy("fy", "qtr")
            .agg(F.max_by(found, order).alias("m")).select("fy", "qtr", "m.*"))


def clean_runs(spark: SparkSession, meta: str, tables: Sequence[str], keep: int = 1,
               older_than: float = 7 * 86400) -> list[str]:
    """Delete the attempts that no kept run names from ``tables``; returns the folders deleted.

    Of each fiscal quarter the last ``keep`` runs that moved the events and the last ``keep`` that
    moved the store are kept. Younger folders than ``older_than`` seconds stay, as a run that is
    still going has not named its attempt yet.
    """
    runs, live = run_log(spark, meta).read(), set()
    for pointer in ("attempt", "store_attempt"):
        last = Window.partitionBy("fy", "qtr").orderBy(F.desc("version"), F.desc("finished_at"))
        kept = (runs.filter(F.col(pointer).isNotNull())
                .withColumn("nr", F.row_number().over(last)).filter(F.col("nr") <= keep))
        live |= {r[0] for r in kept.select(pointer).collect()}
    return remove_dead_attempts(spark, tables, live, older_than, [meta])


RUN_KEYS = ("fy", "qtr", "attempt")


def new_attempt(run_id: str) -> str:
    """A name that no earlier attempt of the run has used."""
    return f"{run_id}-{uuid.uuid4().hex}"


def write_run(df: DataFrame, target: str, attempt: str, fy: int, qtr: int,
              partition_by: Sequence[str] = ()) -> None:
    """Write one quarter's rows of an attempt as partitions of their own.

    Other quarters and attempts are not touched, so ``df`` may read the table it extends. Nothing
    is visible to ``read_run`` before ``append_run_meta`` names the attempt. The rebalance gives
    even files: small partitions are joined, and one holding a large share of the rows is split
    over several tasks.
    """
    keys = [*RUN_KEYS, *partition_by]
    (df.filter((F.col("fy") == fy) & (F.col("qtr") == qtr))
     .withColumn("attempt", F.lit(attempt)).hint("rebalance", *keys)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*keys).parquet(target))


def read_run(spark: SparkSession, target: str, run_meta: DataFrame, schema: T.StructType,
             pointer: str = "attempt") -> DataFrame:
    """Rows of the attempt that each quarter's latest committed pointer names.

    A table of which nothing has been written is empty; other read errors are raised.
    """
    if not exists(spark, target):
        return spark.createDataFrame([], schema)
    stored = spark.read.schema(
        T.StructType([*schema.fields, T.StructField("attempt", T.StringType())])).parquet(target)
    # One row per fiscal quarter, and the join key is the partition path: only the live attempt of
    # each quarter is read.
    live = latest_run(run_meta, pointer).select("fy", "qtr", F.col(pointer).alias("attempt"))
    return stored.join(live, list(RUN_KEYS)).select(*schema.names)


def write_freeze(store: DataFrame, target: str, attempt: str, fy: int, qtr: int,
                 week: str = "fweek") -> None:
    """The closed weeks of one quarter, as a new version of the store."""
    write_run(store, target, attempt, fy, qtr, [week])


def read_freeze(spark: SparkSession, target: str, run_meta: DataFrame, schema: T.StructType
                ) -> DataFrame:
    """The store as the latest run left it that wrote it; runs whose freeze failed do not count."""
    return read_run(spark, target, run_meta, schema, "store_attempt")


# -- exports -------------------------------------------------------------------------------------


def stringify(df: DataFrame) -> DataFrame:
    """All columns as text: NULL as '', dates as yyyy-MM-dd, whole doubles without a fraction."""
    def text(f: T.StructField):
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            s = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            s = F.when(c == F.floor(c), c.cast("decimal(38,0)").cast("string")).otherwise(
                c.cast("string"))
        else:
            s = c.cast("string")
        return F.coalesce(s, F.lit("")).alias(f.name)

    return df.select(*[text(f) for f in df.schema.fields])


def round_for_export(df: DataFrame, ratios: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Ratio columns to three decimals, other measures to whole numbers, halves to even."""
    def rounded(c: str):
        if c in keys:
            return F.col(c)
        if c in ratios:
            return F.bround(F.col(c), 3).alias(c)
        return F.bround(F.col(c), 0).cast("long").alias(c)

    return df.select(*[rounded(c) for c in df.columns])
