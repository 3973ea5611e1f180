"""Point-in-time joins by one sorted pass, for keys with many versions and many facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fiscalweave.operators.forecast import join_scd_asof
from fiscalweave.sources.sinks import rewritten

#: Rows of one key from which it is cut up; days of a cut; tasks that share a cut.
HOT, SPAN, SALTS = 200_000, 64, 8
#: At most this many keys are treated as hot: a hot one holds at least this part of all facts.
MOST = 1_000


def versions_flagged(dim: DataFrame, key: str) -> DataFrame:
    """Versions that can match, with ``layered``: does any version of the key overlap another?"""
    whole = dim.filter(F.col(key).isNotNull() & (F.col("rec_start") <= F.col("rec_end")))
    earlier = W.partitionBy(key).orderBy("rec_start", "rec_end").rowsBetween(
        W.unboundedPreceding, -1)
    meets = F.coalesce(F.col("rec_start") <= F.max("rec_end").over(earlier), F.lit(False))
    return (whole.withColumn("overlaps", meets)
            .withColumn("layered", F.max("overlaps").over(W.partitionBy(key))).drop("overlaps"))


def join_scd_asof_sorted(facts: DataFrame, dim: DataFrame, key: str, date: str,
                         columns: Sequence[str], hot: int = HOT, span: int = SPAN) -> DataFrame:
    """The rows of ``forecast.join_scd_asof``: every fact with the versions valid on its date, both
    ends included; facts without a version, key or date drop out.

    Versions and facts are stacked and sorted by key and date. A window carries the last version
    that has begun, and a fact keeps it if it has not ended yet: v versions and f facts of a key
    cost v + f rows in place of v x f comparisons. The pass is right where a key's versions do not
    overlap; the few keys with overlapping or repeated versions are marked on the way and joined
    by range.

    A hot key, which has at least ``hot`` facts, is cut by date into spans of ``span`` days, each
    dealt over ``SALTS`` parts, and a version takes part in every span it covers, so each cut
    begins with the version that is open there.
    """
    columns = list(columns)
    live = facts.filter(F.col(key).isNotNull() & F.col(date).isNotNull())
    flagged = rewritten(versions_flagged(dim.select(key, "rec_start", "rec_end", *columns), key),
                        "versions")
    per_key = rewritten(live.groupBy(key).agg(
        F.count("*").alias("n"), F.min(date).alias("lo"), F.max(date).alias("hi")), "fact-keys")
    total = per_key.agg(F.sum("n")).first()[0] or 0
    heavy = F.broadcast(per_key.filter(F.col("n") >= max(hot, total // MOST))
                        .select(key, "lo", "hi"))  # at most MOST rows
    cut = lambda day: F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / span)

    begins, lo, hi = F.col("rec_start"), F.col("lo"), F.col("hi")
    spans = F.when(lo.isNull(), F.array(F.lit(0).cast("long"))).when(
        (F.col("rec_end") < lo) | (begins > hi), F.array().cast("array<bigint>")).otherwise(
        F.sequence(cut(F.greatest(begins, lo)), cut(F.least("rec_end", hi))))
    parts = F.when(lo.isNull(), F.array(F.lit(0))).otherwise(
        F.sequence(F.lit(0), F.lit(SALTS - 1)))
    version = F.struct("rec_end", "layered", *columns)
    opened = (flagged.join(heavy, key, "left").withColumn("cut_", F.explode(spans))
              .withColumn("part_", F.explode(parts))
              .select(F.col(key).alias("key_"), "cut_", "part_", begins.alias("time_"),
                      F.lit(0).alias("kind_"), version.alias("version_")))
    row = F.struct(*[F.col(c) for c in facts.columns])
    asked = (live.withColumn("row_", row).join(heavy, key, "left")
             .select(F.col(key).alias("key_"),
                     F.when(lo.isNull(), F.lit(0).cast("long")).otherwise(cut(F.col(date)))
                     .alias("cut_"),
                     F.when(lo.isNull(), F.lit(0)).otherwise(
                         F.pmod(F.xxhash64("row_"), F.lit(SALTS)).cast("int")).alias("part_"),
                     F.col(date).alias("time_"), F.lit(1).alias("kind_"), "row_"))
    both = asked.unionByName(opened, allowMissingColumns=True)
    sofar = (W.partitionBy("key_", "cut_", "part_").orderBy("time_", "kind_")
             .rowsBetween(W.unboundedPreceding, W.currentRow))
    carried = (both.withColumn("open_", F.last("version_", ignorenulls=True).over(sofar))
               .filter((F.col("kind_") == 1) & F.col("open_").isNotNull())
               .select("row_", "time_", "open_"))
    out = ["row_.*", *[F.col(f"open_.{c}").alias(c) for c in columns]]
    layered = flagged.filter("layered")
    if not layered.head(1):
        return carried.filter(F.col("time_") <= F.col("open_.rec_end")).select(*out)
    carried = rewritten(carried, "carried")
    single = carried.filter(~F.col("open_.layered") & (F.col("time_") <= F.col("open_.rec_end")))
    several = join_scd_asof(carried.filter("open_.layered").select("row_.*"), layered, key, date,
                            columns)
    return single.select(*out).unionByName(several)
