"""Joins that hold when one key carries a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a key on the lookup side from which it is dealt over parts of that size, and keys that
#: are dealt at most: a key beyond them holds less than one row in as many.
HOT, MOST = 200_000, 1_000


def left_lookup(fact: DataFrame, dim: DataFrame, on: Sequence[str], hot: int = HOT) -> DataFrame:
    """A left join for a lookup side that may repeat one key very often.

    Adaptive execution splits a hot key of the left side, but not of the right one. So the keys of
    the lookup side are counted, which reads their columns only, and the rows of a hot key are
    dealt over parts; a fact with that key meets every part, and as such a key has a match for
    certain, a part without one gives no row. Both sides are read once, without a hot key as in any
    left join. The count runs when the plan is made, so ``dim`` should be a written table. Whether a
    side is broadcast is left to measured sizes.
    """
    on = list(on)
    counts = dim.groupBy(*on).agg(F.count("*").alias("n")).filter(F.col("n") >= hot)
    heavy = counts.dropna(subset=on).orderBy(F.desc("n")).limit(MOST)
    parts = heavy.select(*on, F.ceil(F.col("n") / hot).cast("int").alias("parts_"))
    known = parts.collect()
    if not known:
        return fact.join(dim, on, "left")
    parts = F.broadcast(fact.sparkSession.createDataFrame(known, parts.schema))  # at most MOST rows
    many = F.coalesce("parts_", F.lit(1))
    asked = fact.join(parts, on, "left").withColumns({
        "hot_": F.col("parts_").isNotNull(),
        "part_": F.explode(F.sequence(F.lit(0), many - 1))}).drop("parts_")
    dealt = dim.join(parts, on, "left").withColumn(
        "part_", F.pmod(F.monotonically_increasing_id(), many).cast("int")).withColumn(
        "match_", F.lit(True)).drop("parts_")
    return (asked.join(dealt, [*on, "part_"], "left")
            .filter(~F.col("hot_") | F.col("match_").isNotNull()).drop("hot_", "part_", "match_"))
