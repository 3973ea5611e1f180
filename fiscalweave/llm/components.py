"""Connected components of a link table, by rounds of joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalweave.llm.store import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, root): for every id of the links (columns a, b) the smallest id reachable from it.

    Alternates two steps until nothing changes: every node links its larger neighbours, then its
    smaller ones, to the smallest neighbour. Stars stay stars, so a hub costs one row per link, and
    the number of rounds grows with the logarithm of the longest path.
    """
    both = lambda e: e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = scratch.write(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a <> b").distinct(), "edges")
    before = None
    while True:
        # Large star: neighbours above the node go to its smallest neighbour (or itself).
        all_ = both(edges)
        least = all_.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (all_.filter("b > a").join(least, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        # Small star: the node and its smaller neighbours go to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = (joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(joined.select("a", F.col("m").alias("b")))
                 .filter("a <> b").distinct())
        after = scratch.write(small, "edges")
        now = after.agg(F.count("*").alias("n"), F.sum(F.col("b").cast("decimal(38,0)")).alias("b"),
                        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        scratch.drop(edges)
        edges = after
        if now == before:
            break
        before = now
    roots = edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("id"), "root")
    return roots.unionByName(
        edges.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())
