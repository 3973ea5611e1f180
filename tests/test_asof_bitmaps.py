"""The sorted point-in-time join against the range join, and bitmaps against distinct counts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fiscalweave.operators import asof, bitmaps
from fiscalweave.operators.forecast import join_scd_asof

DAY = dt.date(2000, 1, 1)
DIM = "agent int, rec_start date, rec_end date, team string, level int"


def day(n):
    return DAY + dt.timedelta(days=n)


def both(facts, dim, **how):
    new = asof.join_scd_asof_sorted(facts, dim, "agent", "on", ["team", "level"], **how)
    old = join_scd_asof(facts, dim, "agent", "on", ["team", "level"])
    assert new.columns == old.columns
    return [sorted((tuple(r) for r in df.collect()), key=repr) for df in (new, old)]


def random_frames(spark, seed, overlaps):
    rnd = random.Random(seed)
    versions = [(None, day(0), day(99), "n", 0), (1, None, day(9), "x", 0), (1, day(5), None, "y", 0),
                (2, day(9), day(1), "never", 0)]
    for a in range(25):
        at = rnd.randint(0, 30)
        for v in range(rnd.randint(0, 6)):
            last = at + rnd.randint(0, 40)
            versions.append((a, day(at), day(last), f"t{v}", None if v == 2 else v))
            at = last + (rnd.randint(-20, 2) if overlaps and a % 3 == 0 else rnd.randint(1, 9))
        if a % 5 == 0:
            versions.append((a, day(at + 1), dt.date(2999, 12, 31), "open", 9))
    facts = [(rnd.choice([None, *range(28)]), rnd.choice([None, *map(day, range(200))]),
              rnd.choice(["p", None]), i % 40) for i in range(1500)]
    facts += [(3, day(20), "same", 1)] * 300
    return (spark.createDataFrame(facts, "agent int, on date, team_ string, n int"),
            spark.createDataFrame(versions, DIM))


@pytest.mark.parametrize("overlaps", [False, True])
@pytest.mark.parametrize("hot", [asof.HOT, 40])
def test_same_as_range_join(spark, overlaps, hot):
    facts, dim = random_frames(spark, 3, overlaps)
    new, old = both(facts, dim, hot=hot, span=16)
    assert len(old) > 400 and new == old


def test_nothing_to_join(spark):
    facts, dim = random_frames(spark, 3, False)
    assert both(facts.limit(0), dim) == [[], []]
    assert both(facts, dim.limit(0)) == [[], []]


def test_one_agent_with_ten_thousand_versions(spark):
    """Every second day a new version, and a third of all facts on this agent."""
    dim = spark.range(10_000).select(
        F.lit(1).alias("agent"), F.date_add(F.lit(DAY), (F.col("id") * 2).cast("int")).alias("rec_start"),
        F.date_add(F.lit(DAY), (F.col("id") * 2 + 1).cast("int")).alias("rec_end"),
        F.concat(F.lit("t"), F.col("id")).alias("team"), F.col("id").cast("int").alias("level"))
    others = spark.range(2, 200).select(
        F.col("id").cast("int").alias("agent"), F.lit(DAY).alias("rec_start"),
        F.lit(dt.date(2999, 12, 31)).alias("rec_end"), F.lit("o").alias("team"), F.lit(0).alias("level"))
    facts = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(2 + F.col("id") % 198).cast("int").alias("agent"),
        F.date_add(F.lit(DAY), (F.col("id") % 20_000).cast("int")).alias("on"), F.col("id"))
    found = asof.join_scd_asof_sorted(facts, dim.unionByName(others), "agent", "on",
                                      ["team", "level"], hot=50_000)
    got = found.agg(F.count("*").alias("n"), F.sum(F.when(
        F.col("agent") == 1, (F.col("level") == F.floor((F.col("id") % 20_000) / 2)).cast("int"))).alias("ok")).first()
    assert got.n == 300_000 and got.ok == 100_000
    # No join of the facts by key is left: the versions come through a window, cut over many tasks.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "SortMergeJoin" not in plan and "CartesianProduct" not in plan
    key = [F.floor(F.datediff("on", F.lit("1970-01-01").cast("date")) / asof.SPAN), "part"]
    parts = facts.filter("agent = 1").withColumn("part", F.col("id") % asof.SALTS).groupBy(*key).count()
    assert parts.agg(F.max("count")).first()[0] < 1_000


# -- bitmaps -------------------------------------------------------------------------------------


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_dense_ids(spark):
    keys = spark.range(100_000).select((F.col("id") % 40_000).cast("string").alias("k")).unionByName(
        spark.createDataFrame([(None,)], "k string"))
    ids = bitmaps.dense_ids(keys, "k").persist()
    assert ids.agg(F.min("id"), F.max("id"), F.count_distinct("id"), F.count_distinct("k"),
                   F.count("*")).first() == (1, 40_000, 40_000, 40_000, 40_000)
    more = bitmaps.dense_ids(spark.range(39_990, 40_020).select(F.col("id").cast("string").alias("k")),
                             "k", ids)
    assert more.count() == 40_020 and more.agg(F.max("id")).first()[0] == 40_020
    assert more.join(ids, ["k", "id"]).count() == 40_000   # earlier numbers stay
    assert bitmaps.dense_ids(keys.limit(0), "k").count() == 0
    ids.unpersist()


def test_bitmaps_count_like_distinct(spark):
    facts = spark.range(90_000).select(
        F.concat(F.lit("t"), F.col("id") % 3).alias("team"), (F.col("id") % 14).cast("int").alias("week"),
        F.when(F.col("id") % 1000 != 0, F.pmod(F.xxhash64("id"), F.lit(70_000))).alias("account_id"))
    ids = bitmaps.dense_ids(facts, "account_id")
    maps = bitmaps.account_bitmaps(facts, ids, ["team", "week"]).persist()
    distinct = lambda *k: facts.groupBy(*k).agg(F.count_distinct("account_id"))
    assert rows(bitmaps.counted(maps, ["team", "week"])) == rows(distinct("team", "week"))
    assert rows(bitmaps.counted(maps, ["team"])) == rows(distinct("team"))
    assert rows(bitmaps.counted(maps, [])) == rows(facts.agg(F.count_distinct("account_id")))
    todate = {(r.team, r.week): r.accounts_to_date
              for r in bitmaps.counted_to_date(maps, ["team"], "week").collect()}
    for week in (0, 5, 13):
        want = dict(rows(facts.filter(F.col("week") <= week).groupBy("team")
                         .agg(F.count_distinct("account_id"))))
        assert {t: todate[t, week] for t in want} == want
    # Two runs, merged: the same as one.
    early = bitmaps.account_bitmaps(facts.filter("week < 7"), ids, ["team"])
    late = bitmaps.account_bitmaps(facts.filter("week >= 5"), ids, ["team"])
    assert rows(bitmaps.counted(early.unionByName(late), ["team"])) == rows(distinct("team"))
    maps.unpersist()


def test_an_account_without_a_number_is_an_error(spark):
    facts = spark.createDataFrame([("a", 1), ("b", 2)], "team string, account_id int")
    ids = bitmaps.dense_ids(facts.filter("account_id = 1"), "account_id")
    with pytest.raises(Exception, match="without a number"):
        bitmaps.account_bitmaps(facts, ids, ["team"]).collect()
