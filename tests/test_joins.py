"""Skewed joins and aggregates: exact results, and hot keys spread over tasks."""

from pyspark.sql import functions as F

from fiscalweave.operators import joins


def facts(spark, n=3000):
    """A third of the rows share key 0, a tenth have none, the rest are spread; copies included."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 97)
    return spark.range(n).select(key.cast("bigint").alias("k"), (F.col("id") % 7).alias("v"))


def dims(spark):
    return spark.range(0, 90).select(F.col("id").alias("k"), (F.col("id") * 10).alias("name")).union(
        spark.createDataFrame([(0, -1), (None, -2)], "k bigint, name bigint"))


def test_same_rows_as_a_plain_join(spark):
    f, d = facts(spark), dims(spark)
    want = f.join(d, ["k"], "left")
    for hot in (joins.HOT, 2, 1):
        got = joins.left_lookup(f, d, ["k"], hot)
        assert got.columns == want.columns and got.dtypes == want.dtypes
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_a_hot_key_on_the_right_is_split(spark):
    """A third of a history belongs to one account: its rows go to several tasks."""
    small = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "5k",
             "spark.sql.adaptive.coalescePartitions.enabled": "false",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
             "spark.sql.shuffle.partitions": "32",
             "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        history = spark.range(60_000).repartition(8).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997).alias("k"),
            F.col("id").alias("n"))
        accounts = spark.range(1000).select(F.col("id").alias("k"))
        joined = joins.left_lookup(accounts, history, ["k"], hot=4_000)
        sizes = [r.n for r in joined.groupBy(F.spark_partition_id()).agg(
            F.count_if(F.col("k") == 0).alias("n")).collect()]
        assert sum(sizes) > 20_000 and max(sizes) < 0.6 * sum(sizes)
        assert joined.filter("n IS NOT NULL").count() == 60_000
        assert joined.filter("n IS NULL").count() == 3
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def scans(df, table):
    """How often the final plan reads a table's file."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    return sum("FileScan" in line and f"{table}.parquet" in line for line in final.splitlines())


def test_histories_are_read_once(spark):
    from conftest import SF

    from fiscalweave.plans import registry

    q = registry.queries()
    assert scans(q["join_owner_chain"](spark, SF), "orders") <= 2
    reuse = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        for name in ("index_metrics", "dashboard_run"):
            assert scans(q[name](spark, SF), "lineitem") == 1, name
    finally:
        spark.conf.set("spark.sql.exchange.reuse", reuse)


def test_hot_copies_and_accounts_give_whole_results(spark):
    """A third of the bookings is one row copied, a third is one account: nothing is lost."""
    import datetime as dt
    from functools import reduce

    from pyspark.sql import DataFrame

    from fiscalweave.config import DEFAULT_REGIONS
    from fiscalweave.functions.calendar import FiscalRule
    from fiscalweave.operators import counts, events
    from fiscalweave.plans.binding import TAG_RULES

    i = F.col("id")
    copy, varied = i % 3 == 0, lambda n: F.when(i % 3 == 0, 1).otherwise(i % n)
    pick = lambda n, *xs: F.element_at(F.array(*map(F.lit, xs)), (varied(n) % len(xs) + 1).cast("int"))
    facts = spark.range(30_000).select(
        F.date_add(F.lit(dt.date(1999, 8, 1)), varied(366).cast("int")).alias("event_date"),
        pick(7, "new", "upgrade", "signup").alias("event_type"), pick(5, "F", "O").alias("category"),
        pick(11, "CORE", "PAY", "PMT").alias("offering"), pick(13, "PROMO", "SMALL", "MEDIUM").alias("product"),
        pick(17, "hot gear", "Widget", "blue gear").alias("offer_name"), pick(19, "Peru", "Canada").alias("country"),
        pick(23, "N", "M").alias("team_raw"), F.when(copy | (i % 3 == 1), 7).otherwise(i % 1000).alias("account_id"),
        varied(20).alias("firm_id"), F.lit(1).cast("bigint").alias("agent_id"),
        F.lit("c").alias("channel"), F.lit("s").alias("super_channel"))
    agents = spark.createDataFrame([(1, "A", events.OPEN_END)], "agent_id bigint, full_name string, rec_end date")
    got = events.weekly_events(facts, agents, FiscalRule(), TAG_RULES, DEFAULT_REGIONS, 2000, excluded_firms=[7])
    keys = ["event_date", "country", "team_raw", "event_type", "account_id", "firm_id", "product", "offer_name",
            "offering"]
    naive = reduce(DataFrame.unionByName, [
        facts.filter(r.predicate([7])).filter("event_date <= DATE'2000-07-31'").select(*keys).distinct()
        .select(F.lit(r.tag).alias("table_type")) for r in TAG_RULES])
    want = dict(map(tuple, naive.groupBy("table_type").count().collect()))
    assert dict(map(tuple, counts.type_row_counts(got).collect())) == want
    assert len(want) > 8 and want["SALES"] < 10_000
