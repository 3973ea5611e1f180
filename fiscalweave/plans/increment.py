"""The incremental weekly run: fold a batch of changes into the stored counts of open weeks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalweave.operators import incremental as inc
from fiscalweave.sources import sinks
from fiscalweave.sources.commits import CommitLog, exists, remove_dead_attempts

_INT, _LONG, _TEXT = T.IntegerType(), T.LongType(), T.StringType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


#: Which attempt holds a week, and whether the week is closed.
POINTERS = _struct(fy=_INT, qtr=_INT, fweek=_INT, attempt=_TEXT, closed=T.BooleanType())
_CELL = {"fy": _INT, "qtr": _INT, "fweek": _INT, "team": _TEXT, "table_type": _TEXT}
_STORED = {"cells": _struct(**_CELL, n=_LONG, attempt=_TEXT),
           "support": _struct(**_CELL, event=T.BinaryType(), support=_LONG, attempt=_TEXT)}
_KEYS = [*inc.WEEK, "attempt"]


@dataclass(frozen=True)
class CountStore:
    """Counts per cell, and the support of open weeks, of which every week is a partition of the
    attempt that wrote it last; a numbered commit moves the pointers of the weeks of a run."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def log(self, spark: SparkSession) -> CommitLog:
        return CommitLog(spark, self.path("commits"), POINTERS, inc.WEEK)

    def pointers(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """One row per week: where it stands as of a version."""
        where = F.struct("attempt", "closed")
        return (self.log(spark).read(version).groupBy(*inc.WEEK)
                .agg(F.max_by(where, "version").alias("p")).select(*inc.WEEK, "p.*"))

    def _read(self, spark: SparkSession, name: str, pointers: DataFrame) -> DataFrame:
        schema = _STORED[name]
        if not exists(spark, self.path(name)):
            return spark.createDataFrame([], schema).drop("attempt")
        # A pointer per fiscal week names a partition, so no other partition is listed or read.
        live = pointers.select(*_KEYS).collect()
        stored = spark.read.schema(schema).parquet(self.path(name)).filter(
            F.col("attempt").isin(sorted({r.attempt for r in live}))
            & F.col("fweek").isin(sorted({r.fweek for r in live})))
        exact = F.broadcast(spark.createDataFrame(live, pointers.select(*_KEYS).schema))
        return stored.join(exact, _KEYS).select(*[c for c in schema.names if c != "attempt"])

    def cells(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """(cell, n): the counts of every week, closed or open."""
        return self._read(spark, "cells", self.pointers(spark, version))

    def support(self, spark: SparkSession, pointers: DataFrame) -> DataFrame:
        return self._read(spark, "support", pointers)

    def clean(self, spark: SparkSession, older_than: float = 7 * 86400) -> list[str]:
        """Delete attempts that no week points to, and the support of closed weeks."""
        now = self.pointers(spark).collect()  # a row per fiscal week
        live = {r.attempt for r in now}
        logs = [self.path("commits")]
        gone = remove_dead_attempts(spark, [self.path("cells")], live, older_than, logs)
        still = {r.attempt for r in now if not r.closed}
        return gone + remove_dead_attempts(spark, [self.path("support")], still, older_than)


def apply_changes(store: CountStore, changes: DataFrame, run_id: str, fy: int, week: int) -> int:
    """Fold a batch of ``incremental.event_changes`` into the store; returns the new version.

    Changes of closed weeks are ignored. The weeks that the batch touches are read, folded and
    written anew; no other week is read. Weeks before ``week`` of fiscal year ``fy`` that have
    something to count are then closed, so a week without events can still be filled later. One
    numbered commit publishes it all; if another run has committed one of these weeks since this
    one started, ``CommitConflict`` is raised and the batch can be applied again.
    """
    spark = changes.sparkSession
    log, attempt = store.log(spark), sinks.new_attempt(run_id)
    base = log.head()
    before = sinks.rewritten(store.pointers(spark, base), "pointers")
    closed = F.broadcast(before.filter("closed").select(*inc.WEEK))  # a row per fiscal week
    batch = sinks.rewritten(changes.join(closed, list(inc.WEEK), "left_anti"), "changes")
    touched = F.broadcast(batch.select(*inc.WEEK).distinct())  # likewise
    open_now = before.join(touched, list(inc.WEEK), "left_semi")

    folded = sinks.rewritten(inc.fold(store.support(spark, open_now), batch), "folded")
    cells = inc.add_deltas(store._read(spark, "cells", open_now), inc.cell_deltas(folded))
    for name, rows in (("support", inc.new_support(folded)), ("cells", cells)):
        (rows.withColumn("attempt", F.lit(attempt)).hint("rebalance", *_KEYS)
         .write.mode("append").partitionBy("attempt", *inc.WEEK).parquet(store.path(name)))

    gone_by = (F.col("fy") < fy) | ((F.col("fy") == fy) & (F.col("fweek") < week))
    schema = _STORED["cells"]
    counted = (spark.read.schema(schema).parquet(store.path("cells"))
               .filter(F.col("attempt") == attempt).select(*inc.WEEK).distinct()
               if exists(spark, store.path("cells")) else touched.limit(0))
    moved = (touched.withColumn("attempt", F.lit(attempt))
             .join(counted.withColumn("some", F.lit(True)), list(inc.WEEK), "left")
             .withColumn("closed", gone_by & F.coalesce("some", F.lit(False))).drop("some"))
    passed = (before.filter(~F.col("closed") & gone_by)
              .join(touched, list(inc.WEEK), "left_anti")
              .join(store.cells(spark, base).select(*inc.WEEK).distinct(), list(inc.WEEK),
                    "left_semi").withColumn("closed", F.lit(True)))
    return log.commit(moved.unionByName(passed), base)
