"""Facts by fiscal period, account tables by account, and the index over tag rules: the same rows
as the plain operators, and the plans they are made for."""

import datetime as dt
import random

import pytest
from conftest import SF
from pyspark.sql import functions as F

from fiscalweave.config import TagRule
from fiscalweave.operators import calendar as cal
from fiscalweave.operators import events, owners, rule_index
from fiscalweave.plans import binding as b
from fiscalweave.plans import registry
from fiscalweave.sources import layout


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# -- fiscal periods ------------------------------------------------------------------------------


def days(spark):
    return cal.date_ext(cal.date_spine(spark, dt.date(1998, 8, 1), dt.date(2001, 7, 31)), b.RULE, b.AS_OF)


def fact(spark, n=4_000):
    day = F.date_add(F.lit(dt.date(1998, 8, 1)), (F.col("id") * 37 % 1096).cast("int"))
    return spark.range(n).select(F.when(F.col("id") % 50 != 0, day).alias("event_date"),
                                 (F.col("id") % 5).alias("kind"))


def test_partitions_are_pruned_by_what_the_calendar_keeps(spark, tmp_path):
    target = str(tmp_path / "facts")
    layout.write_by_period(fact(spark), target, b.RULE)
    stored = layout.read_by_period(spark, target)
    assert stored.count() == 4_000  # rows without a date are kept
    ext = days(spark)
    stored_days = str(tmp_path / "days")
    ext.write.parquet(stored_days)
    recent = spark.read.parquet(stored_days).filter("fiscal_qtr_age IN (0, 1) AND week_age > 2")
    got = layout.in_calendar(stored, recent)
    want = fact(spark).join(recent.withColumnRenamed("date", "event_date"), "event_date")
    assert rows(got.select("event_date", "kind", "week")) == rows(want.select("event_date", "kind", "week"))
    scan = [x for x in plan(got).splitlines() if "PartitionFilters" in x and "kind" in x]
    assert len(scan) == 1 and "dynamicpruning" in scan[0].split("PushedFilters")[0]
    files = {r.path.split("fy=")[1].split("/part")[0] for r in
             got.select(F.col("event_date"), F.concat(F.lit("fy="), "fy", F.lit("/qtr="), "qtr", F.lit("/part"))
                        .alias("path")).collect()}
    assert files == {"2000/qtr=3", "2000/qtr=4"}


def test_a_period_that_is_named_prunes_before_the_run(spark, tmp_path):
    target = str(tmp_path / "facts")
    layout.write_by_period(fact(spark), target, b.RULE)
    got = layout.read_by_period(spark, target).filter("fy = 2000 AND qtr = 4")
    lo, hi = b.RULE.bounds(2000, 4)
    assert got.count() == fact(spark).filter(F.col("event_date").between(F.lit(lo), F.lit(hi))).count()
    scan = [x for x in plan(got).splitlines() if "PartitionFilters" in x]
    assert "(fy" in scan[0].split("PushedFilters")[0] and "(qtr" in scan[0].split("PushedFilters")[0]


# -- buckets -------------------------------------------------------------------------------------


def test_account_tables_join_without_a_shuffle(spark, no_broadcast):
    t = b.Tables(spark, SF)
    keyed = t.accounts.select(F.col("company_id").alias("firm_id"), F.col("id").alias("account"))
    live = owners.owner_history_rows(t.owner_history)
    names = [layout.write_bucketed(keyed, "account", 4, "accounts"),
             layout.write_bucketed(live, "account", 4, "history")]
    accounts, history = map(spark.table, names)
    joined = accounts.join(history, "account", "left")
    assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
    assert rows(joined) == rows(keyed.join(live, "account", "left"))
    # W1 on the bucketed history: one row per account, picked where the bucket lies.
    picked = owners.latest_owner(history.withColumns({"type": F.lit("Owner"), "isdeleted": F.lit(False)}))
    assert "Exchange" not in plan(picked)
    assert rows(picked) == rows(owners.latest_owner(t.owner_history))
    # The facts are shuffled to meet the accounts, the accounts are not.
    facts = t.materialize(t.bookings.select(F.col("account_id").alias("account"), "event_type"), "facts")
    assert plan(facts.join(accounts, "account")).count("Exchange") == 1
    for name in names:
        layout.drop(spark, name)
    assert not spark.catalog.tableExists(names[0])


def test_buckets_follow_the_rows(spark, no_broadcast):
    few, many = spark.range(10), spark.range(1_001)
    assert layout.bucket_count(few, rows=100) == 8 and layout.bucket_count(few, many, rows=100) == 11
    # Half of the rows have no key; they are spread, and still meet nothing.
    left = spark.range(4_000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 400).alias("k"), "id")
    right = spark.range(900).select(F.when(F.col("id") % 3 != 0, F.col("id")).alias("k"),
                                    (F.col("id") * 7).alias("v"))
    names = [layout.write_bucketed(layout.spread_missing(df, "k"), ["k", layout.SPREAD], 16, "spread")
             for df in (left, right)]
    stored, other = map(spark.table, names)
    sizes = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 4_000 and max(sizes) < 800
    joined = stored.join(other, ["k", layout.SPREAD], "left")
    assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
    assert rows(joined.drop(layout.SPREAD)) == rows(left.join(right, "k", "left"))
    for name in names:
        layout.drop(spark, name)


def odd_chain(spark, root):
    """Orders without and with repeated keys, several owners of an account, customers without a key."""
    day = F.to_timestamp_ntz(F.lit("2000-01-05 00:00:00"))
    i = F.col("id")
    made = {
        "orders": spark.range(3_000).select(
            F.when(i % 97 != 0, i % 2_000).alias("o_orderkey"),
            F.when(i % 4 != 0, i % 150).alias("o_custkey"),
            F.when(i % 2 == 0, "O").otherwise("F").alias("o_orderstatus"),
            F.lit(1.0).alias("o_totalprice"), day.alias("o_orderdate"),
            F.when(i % 5 == 0, "5-LOW").otherwise("1-URGENT").alias("o_orderpriority")),
        "customer": spark.range(200).select(
            F.when(i % 9 != 0, i % 180).alias("c_custkey"), F.lit("c").alias("c_name"),
            F.lit(1).alias("c_nationkey"), F.lit(1.0).alias("c_acctbal"), F.lit("M").alias("c_mktsegment")),
        "supplier": spark.range(90).select(
            F.when(i % 11 != 0, i % 80).alias("s_suppkey"), F.lit("s").alias("s_name"),
            F.lit(1).alias("s_nationkey"), F.lit(1.0).alias("s_acctbal"))}
    for name, df in made.items():
        df.write.parquet(f"{root}/{name}.parquet")


def test_tasks_of_the_bucketed_chain_follow_the_rows(spark, tmp_path, no_broadcast, monkeypatch):
    odd_chain(spark, str(tmp_path))
    made, write = [], layout.write_bucketed
    monkeypatch.setitem(layout.bucket_count.__kwdefaults__, "rows", 100)
    monkeypatch.setattr(registry, "PAIRS_A_TASK", 1_000)
    monkeypatch.setattr(layout, "write_bucketed", lambda df, key, buckets, *a: (
        made.append(buckets), write(df, key, buckets, *a))[1])
    got = registry.queries()["owner_chain_bucketed"](spark, str(tmp_path))
    exchanges = [x for x in plan(got).splitlines() if "Exchange" in x]
    t = b.Tables(spark, str(tmp_path))
    chain = owners.join_owner_chain(t.account_status, t.accounts, t.owner_history, t.users, t.agents, b.AS_OF)
    want = chain.groupBy("account_owner").agg(F.count(F.lit(1)).alias("n"),
                                              F.count_distinct("account_id").alias("accounts"))
    assert rows(got) == rows(want) and got.columns == want.columns
    live = owners.owner_history_rows(t.owner_history).count()
    assert made[:2] == [-(-live // 100)] * 2 and made[2] == made[3] >= 30
    # The pairs are dealt over tasks by their number, and the companies meet their owners in place.
    assert len(exchanges) == 2 and f", {-(-chain.count() // 1_000)})" in exchanges[1], exchanges


# -- rules ---------------------------------------------------------------------------------------


def test_same_tags_as_asking_every_rule(spark):
    t = b.Tables(spark, SF)
    odd = [TagRule("NOT", product_not="PROMO"), TagRule("LIKE", offer_contains=("ho", "t")),
           TagRule("ANY", event_type="new", offer_contains_any_case=("GEAR",), keep_excluded_firms=False),
           TagRule("SAME", event_type="new"), TagRule("SAME", offering="CORE")]
    for rules in (b.TAG_RULES, [*b.TAG_RULES, *odd], odd[:1], odd[1:2]):
        for firms in ((), b.EXCLUDED_FIRMS):
            want = events.multi_rule_tag(t.bookings, rules, firms)
            got = rule_index.multi_rule_tag(t.bookings, rules, firms)
            assert got.columns == want.columns
            count = lambda df: rows(df.groupBy("table_type", "account_id", "offer_name").count())
            assert count(got) == count(want)
    with pytest.raises(ValueError):
        rule_index.multi_rule_tag(t.bookings, [TagRule("none")])


def test_nulls_and_many_rules(spark):
    rnd = random.Random(6)
    pick = lambda *xs: rnd.choice([None, *xs])
    facts = spark.createDataFrame(
        [(pick("new", "old"), pick("CORE", "PAY"), pick("F", "O"), pick("P0", "P1", "P2"),
          pick("hot Gear", "cold"), pick(1, 2, 3)) for _ in range(400)],
        "event_type string, offering string, category string, product string, offer_name string, firm_id int")
    rules = [TagRule(f"r{i}", *[rnd.choice([None, v, f"{v}{i}"]) for v in ("new", "CORE", "F")],
                     product=rnd.choice([None, f"P{i % 9}"]), product_not=rnd.choice([None, "P1"]),
                     offer_contains=rnd.choice([(), ("Gear",)]), offer_contains_any_case=("o",),
                     keep_excluded_firms=bool(i % 2)) for i in range(1_000)]
    got = rule_index.multi_rule_tag(facts, rules, [2])
    some = [r for r in rules if rnd.random() < 0.06]
    names = {r.tag for r in some}
    want = events.multi_rule_tag(facts, some, [2])
    assert rows(got.filter(F.col("table_type").isin(list(names)))) == rows(want)
    # A lookup per kind of fixed fields, however many rules there are; and the facts are read once.
    assert plan(got).count("BroadcastHashJoin") <= 16 and "Python" not in plan(got)
