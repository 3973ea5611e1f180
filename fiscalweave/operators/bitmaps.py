"""Distinct counts that add up: exact bitmaps of accounts per week and team.

A distinct count cannot be added over weeks or teams, so every total would need the facts again.
A bitmap can be OR-ed: facts are read once, and weeks, quarter-to-date, totals and later runs are
made from the bitmaps. Accounts get dense numbers, so a bitmap of 32,768 accounts takes 4 KB.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fiscalweave.sources.sinks import rewritten

_TASK = 33  # monotonically_increasing_id: the task above this bit, the row of the task below


def dense_ids(keys: DataFrame, key: str, known: DataFrame | None = None) -> DataFrame:
    """(key, id): numbers from 1 without gaps for all distinct values of ``key`` but null.

    ``known`` is the (key, id) of earlier runs; its numbers stay, and new keys follow the largest,
    so bitmaps of several runs can be merged. Every task numbers its own rows, and a prefix sum
    over the tasks' counts, a row per task, gives each task its start: nothing is sorted as a whole.
    """
    keys = keys.filter(F.col(key).isNotNull()).select(key).distinct()
    first = 0
    if known is not None:
        keys = keys.join(known.select(key), key, "left_anti")
        first = known.agg(F.max("id")).first()[0] or 0
    placed = rewritten(keys.withColumn("place", F.monotonically_increasing_id()), "places")
    task = F.shiftright("place", _TASK).alias("task")
    counts = placed.groupBy(task).agg(F.count("*").alias("n"))
    ahead = W.orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    starts = F.broadcast(counts.select(
        "task", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start")))
    row = F.col("place") - F.shiftleft("task", _TASK)
    new = (placed.withColumn("task", task).join(starts, "task")
           .select(key, (F.lit(first + 1) + F.col("start") + row).alias("id")))
    return new if known is None else known.select(key, "id").unionByName(new)


def account_bitmaps(facts: DataFrame, ids: DataFrame, groups: Sequence[str],
                    account: str = "account_id") -> DataFrame:
    """(groups, bucket, bits): the accounts of each group, in pieces of 32,768 account numbers.

    Facts are made distinct per group and account before they are shuffled. An account without a
    number is an error of the caller: number the facts' accounts with ``dense_ids`` first.
    """
    seen = facts.select(*groups, account).filter(F.col(account).isNotNull()).distinct()
    numbered = seen.join(ids, account, "left").withColumn("id", F.coalesce(
        "id", F.raise_error(F.lit("account without a number")).cast("long")))
    return (numbered.groupBy(*groups, F.bitmap_bucket_number("id").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits")))


def merged(bitmaps: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Bitmaps of coarser groups, or of several runs stacked on each other."""
    return bitmaps.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counted(bitmaps: DataFrame, groups: Sequence[str], name: str = "accounts") -> DataFrame:
    """Distinct accounts per group."""
    return (merged(bitmaps, groups).groupBy(*groups)
            .agg(F.sum(F.bitmap_count("bits")).alias(name)))


def counted_to_date(bitmaps: DataFrame, groups: Sequence[str], order: str,
                    name: str = "accounts_to_date") -> DataFrame:
    """Distinct accounts per group from the first value of ``order`` up to each one it has.

    Per piece, the OR of all earlier weeks says which accounts a week sees for the first time;
    those counts are then added up over the weeks.
    """
    upto = W.partitionBy(*groups, "bucket").orderBy(order).rowsBetween(
        W.unboundedPreceding, W.currentRow)
    count = F.bitmap_count(F.bitmap_or_agg("bits").over(upto))
    before = F.lag("seen").over(W.partitionBy(*groups, "bucket").orderBy(order))
    first = (merged(bitmaps, [*groups, order]).withColumn("seen", count)
             .withColumn("new", F.col("seen") - F.coalesce(before, F.lit(0)))
             .groupBy(*groups, order).agg(F.sum("new").alias("new")))
    running = W.partitionBy(*groups).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return first.select(*groups, order, F.sum("new").over(running).alias(name))
