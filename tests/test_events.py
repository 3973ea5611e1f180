import datetime as dt
from functools import reduce

from hypothesis import given, settings
from hypothesis import strategies as some
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalweave.config import DEFAULT_REGIONS, RegionRules, TagRule, broadest
from fiscalweave.functions.calendar import FiscalRule
from fiscalweave.operators import events as ev
from fiscalweave.operators import forecast as fc
from fiscalweave.plans.binding import EXCLUDED_FIRMS, TAG_RULES
from fiscalweave.schemas import WEEKLY_EVENTS, conform, require_columns

D = dt.date
RULE = FiscalRule()
SCHEMA = ("event_date date, event_type string, category string, offering string, product string, "
          "offer_name string, country string, team_raw string, account_id bigint, firm_id bigint, "
          "agent_id bigint, channel string, super_channel string")


def booking(**kw):
    base = dict(event_date=D(2000, 5, 1), event_type="new", category="F", offering="CORE",
                product="SMALL", offer_name="red ring", country="Chile", team_raw="N",
                account_id=1, firm_id=1, agent_id=1, channel="c", super_channel="s")
    return tuple((base | kw).values())


def bookings(spark, *rows):
    return spark.createDataFrame([booking(**r) for r in rows], SCHEMA)


def agents(spark, *rows):
    return spark.createDataFrame(rows, "agent_id bigint, full_name string, rec_start date, rec_end date")


CURRENT = (1, "A", D(1999, 1, 1), ev.OPEN_END)


def events(spark, rows, agent_rows=(CURRENT,), **kw):
    return ev.weekly_events(bookings(spark, *rows), agents(spark, *agent_rows), RULE, TAG_RULES,
                            DEFAULT_REGIONS, 2000, excluded_firms=EXCLUDED_FIRMS, **kw)


def tags(df):
    return sorted(r.table_type for r in df.collect())


def test_row_with_several_tags(spark):
    assert tags(events(spark, [dict(product="PROMO", offer_name="hot gear")])) == [
        "ADV", "ADV_SALES", "PKG_A", "PKG_A_ADV", "SALES"]


def test_copies_collapse_per_tag_but_countries_stay(spark):
    rows = [dict()] * 3 + [dict(country="Peru")]
    got = events(spark, rows)
    assert tags(got) == ["SALES", "SALES"]
    assert [r.region for r in got.collect()] == ["LATAM", "LATAM"]
    assert len(set(got.collect())) == 1  # equal rows, both counted


def test_category_is_no_key_so_tags_merge(spark):
    rows = [dict(category="F", offer_name="hot gear"), dict(category="O", offer_name="hot gear")]
    assert tags(events(spark, rows)) == ["PKG_A", "SALES"]


def test_missing_and_excluded_firms(spark):
    rows = [dict(offer_name="Widget red", firm_id=f) for f in (None, 7, 2)]
    got = events(spark, rows)
    assert sorted((r.table_type, r.firm_id) for r in got.collect() if r.table_type == "PKG_ANY") == [
        ("PKG_ANY", "2")]
    assert tags(got).count("SALES") == 3


def test_empty_exclusion_list_excludes_nothing(spark, rows):
    df = bookings(spark, dict(firm_id=None), dict(firm_id=7))
    assert ev.filter_exclude_firms(df, []).count() == 2
    assert ev.filter_exclude_firms(df, [7]).count() == 0


def test_period_and_team_gates(spark):
    rows = [dict(event_date=D(1999, 7, 31)), dict(event_date=D(1999, 8, 1), team_raw="X"),
            dict(event_date=D(2000, 7, 31), account_id=2)]
    assert [(r.fy, r.qtr, r.fweek) for r in events(spark, rows, teams=["N"]).collect()] == [
        (2000, 4, 53)]


def test_duplicate_current_agent_fans_out_before_dedupe(spark):
    twice = [CURRENT, CURRENT]
    assert tags(events(spark, [dict()], twice)) == ["SALES"]
    renamed = [CURRENT, (1, "B", D(1999, 1, 1), ev.OPEN_END)]
    assert tags(events(spark, [dict()], renamed)) == ["SALES", "SALES"]
    assert tags(events(spark, [dict()], [(1, "A", D(1999, 1, 1), D(2000, 1, 1))])) == []


def test_scd_boundaries_are_inclusive(spark, rows):
    dim = agents(spark, (1, "old", D(2000, 1, 1), D(2000, 4, 30)),
                 (1, "new", D(2000, 5, 1), ev.OPEN_END))
    facts = bookings(spark, *[dict(event_date=d) for d in (
        D(1999, 12, 31), D(2000, 1, 1), D(2000, 4, 30), D(2000, 5, 1))])
    got = fc.join_scd_asof(facts, dim, "agent_id", "event_date", ["full_name"])
    assert rows(got.select("event_date", "full_name")) == [
        (D(2000, 1, 1), "old"), (D(2000, 4, 30), "old"), (D(2000, 5, 1), "new")]


def test_regions(spark):
    df = spark.createDataFrame([("Chile",), ("Canada",), ("France",), (None,)], "country string")
    got = ev.region_bucket(df, DEFAULT_REGIONS).collect()
    assert [r.region for r in got] == ["LATAM", "Canada", "Other", "Other"]
    two = RegionRules({"A": ["x"], "B": ["y"]}, other="-")
    df = spark.createDataFrame([("x",), ("y",), ("z",)], "country string")
    assert [r.region for r in ev.region_bucket(df, two).collect()] == ["A", "B", "-"]


def test_contract_schema(spark):
    assert events(spark, [dict()]).schema.simpleString() == WEEKLY_EVENTS.simpleString()
    assert conform(spark.range(1), WEEKLY_EVENTS).first().fy is None


def test_required_columns(spark):
    df = spark.range(1)
    assert require_columns(df, ["id"]) is df
    try:
        require_columns(df, ["id", "x"])
    except ValueError as error:
        assert "'x'" in str(error)
    else:
        raise AssertionError


def test_quotes_in_rules(spark):
    rule = TagRule("it's", offer_contains=("o'b\\x",))
    df = bookings(spark, dict(offer_name="foo'b\\xar"), dict(offer_name="foobar"))
    got = ev.multi_rule_tag(df, [rule]).collect()
    assert [(r.table_type, r.offer_name) for r in got] == [("it's", "foo'b\\xar")]


def test_broadest_rules():
    assert [r.tag for r in broadest(TAG_RULES)] == [
        "SALES", "PAYROLL", "ADV_UPGRADES", "SIGNUP", "PKG_A", "PKG_B", "PKG_C", "PKG_LEDGER"]


RULES = some.builds(
    TagRule, some.sampled_from("abcde"), event_type=some.sampled_from(["new", "upgrade"]),
    category=some.sampled_from([None, "F"]), product=some.sampled_from([None, "PROMO"]),
    product_not=some.sampled_from([None, "PROMO", "SMALL"]),
    offer_contains=some.sampled_from([(), ("o",), ("o", "g")]),
    keep_excluded_firms=some.booleans())


@settings(max_examples=8, deadline=None)
@given(some.lists(RULES, min_size=1, max_size=4, unique_by=lambda r: r.tag))
def test_tagging_equals_one_query_per_rule(spark, rules):
    df = bookings(spark, *[
        dict(event_type=e, category=c, product=p, offer_name=o, firm_id=f)
        for e in ("new", "upgrade") for c in ("F", "O") for p in ("PROMO", "SMALL", None)
        for o in ("log", "or", "x", None) for f in (7, 1, None)])
    one_pass = ev.multi_rule_tag(df, rules, [7])
    apart = reduce(DataFrame.unionByName, [
        df.filter(r.predicate([7])).withColumn("table_type", F.lit(r.tag)) for r in rules])
    assert one_pass.exceptAll(apart).count() == 0 and apart.exceptAll(one_pass).count() == 0
    covered = reduce(lambda a, b: a | b, [r.predicate([7]) for r in rules])
    assert df.filter(ev.any_rule(rules, [7])).count() == df.filter(covered).count()


def test_one_fact_scan_and_no_python(spark):
    from conftest import SF

    from fiscalweave.plans.binding import Tables

    plan = Tables(spark, SF).events()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1
    assert "Python" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_seventy_rules_in_one_pass(spark):
    rules = [TagRule(f"T{i}", event_type="new", offer_contains=(f"gear{i}x",)) for i in range(70)]
    rows = bookings(spark, *[dict(offer_name=f"gear{i}x", account_id=i) for i in range(70)],
                    dict(offer_name="gear0x gear69x", account_id=99))
    got = ev.weekly_events(rows, agents(spark, CURRENT), RULE, rules, DEFAULT_REGIONS, 2000)
    n = {r.table_type: r["count"] for r in got.groupBy("table_type").count().collect()}
    assert n == {f"T{i}": 2 if i in (0, 69) else 1 for i in range(70)}


def test_two_years_from_one_scan(spark):
    rows = bookings(spark, dict(event_date=D(1999, 5, 1)), dict(event_date=D(2000, 5, 1)),
                    dict(event_date=D(1998, 5, 1)))
    got = ev.weekly_events(rows, agents(spark, CURRENT), RULE, TAG_RULES[:1], DEFAULT_REGIONS, 2000,
                           years=2)
    assert sorted(r.fy for r in got.collect()) == [1999, 2000]
