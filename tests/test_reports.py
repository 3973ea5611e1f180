import datetime as dt

import pytest
from pyspark.sql import functions as F

from fiscalweave.config import MotionRules, OpportunityRules, ProductRules
from fiscalweave.functions.calendar import FiscalRule
from fiscalweave.operators import counts as cnt
from fiscalweave.operators import forecast as fc
from fiscalweave.operators import kpi, report

D = dt.date
EVENTS = ("fy int, qtr int, fweek int, team_raw string, table_type string, firm_id string, "
          "event string")


def events(spark, *rows):
    """(week, team, type[, firm, event]) in FY26 Q4."""
    full = [(26, 4, *r, *("f", "active_cancel")[len(r) - 3:]) for r in rows]
    return spark.createDataFrame(full, EVENTS)


SALES = [(40, "N", "S")] * 2 + [(40, "M", "S")] + [(42, "N", "S")] * 5 + [(42, None, "S")] + [
    (None, "N", "S")] + [(41, "N", "C")] * 2 + [(42, "N", "C")] * 2 + [(42, "M", "P")]


def test_counts_and_star(spark, rows):
    got = cnt.week_team_type_counts(events(spark, *SALES))
    by = {(r.fweek, r.team, r.table_type): r.n for r in got.collect()}
    assert by[40, "N", "S"] == 2 and by[40, "*", "S"] == 3 and by[42, "", "S"] == 1
    for (week, team, kind), n in by.items():
        if team == "*":
            assert n == sum(v for (w, t, k), v in by.items() if (w, k) == (week, kind) and t != "*")


def test_series_and_labels(spark, rows):
    e = events(spark, *SALES)
    series = cnt.weekly_series(e)
    assert rows(series.filter("table_type = 'S'").select("fweek", "n")) == [(40, 3), (42, 6)]
    mapped = cnt.weekly_series(e, {"N": "x", "M": "x"}).filter("table_type = 'S'")
    assert rows(mapped.select("label", "fweek", "n")) == [("x", 40, 3), ("x", 42, 5)]
    relabelled = cnt.relabel_teams(cnt.week_team_type_counts(e), {"N": "x", "M": "x", "Z": "z"})
    assert rows(relabelled.filter("table_type = 'P'").select("team", "fweek", "n")) == [("x", 42, 1)]
    best = {r.table_type: r for r in cnt.best_worst_week(series).collect()}
    assert (best["C"].best_week, best["C"].worst_week) == (41, 41)        # tie: earliest
    assert (best["S"].best_week, best["S"].worst_week) == (40, 42)
    avg = {r.table_type: r for r in cnt.weekly_average(series).collect()}
    assert (avg["S"].avg_n, avg["S"].vs_avg) == (4, 2)                    # 4.5 rounds to even
    assert dict(map(tuple, cnt.type_row_counts(e).collect())) == {"S": 10, "C": 4, "P": 1}


def test_driver_weeks(spark, rows):
    series = cnt.weekly_series(events(spark, *SALES))
    assert rows(cnt.driver_weeks(series, "S", "C")) == [(26, 4, "S", 42, 40)]
    assert rows(cnt.driver_weeks(series, "X", "C")) == [(26, 4, "C", 42, 41)]
    assert rows(cnt.driver_weeks(series, "P", "C")) == [(26, 4, "P", 42, None)]
    assert rows(cnt.driver_weeks(series, "X", "Y")) == []


def test_wow_uses_present_weeks(spark, rows):
    c = kpi.team_counts(cnt.week_team_type_counts(events(spark, *SALES)))
    got = {(r.table_type, r.team, r.fweek): (r.n, r.prev_n, r.wow) for r in cnt.wow_change(c, "S").collect()}
    assert got["S", "N", 42] == (5, 2, 3) and got["S", "N", 40] == (2, None, None)
    assert got["S", "M", 42] == (0, 1, -1) and ("S", "N", 41) not in got
    running = {(r.team, r.fweek): r.qtd for r in cnt.qtd_running(c).filter("table_type = 'S'").collect()}
    assert running["N", 42] == 7


def test_trailing_average_is_dense(spark):
    c = spark.createDataFrame([(26, 3, 30, "N", "S", 8), (26, 4, 40, "N", "S", 4), (26, 4, 44, "N", "S", 8)],
                              "fy int, qtr int, fweek int, team string, table_type string, n bigint")
    weeks = spark.createDataFrame([(26, 3, w) for w in (29, 30)] + [(26, 4, w) for w in range(40, 45)],
                                  "fy int, qtr int, week int")
    got = {r.fweek: r for r in cnt.trailing_avg_index(c, weeks).filter("qtr = 4").collect()}
    assert [got[w].trailing_avg for w in range(40, 45)] == [4.0, 2.0, 4 / 3, 1.0, 2.0]
    assert got[44].prior_qtr_avg == 4.0 and got[44].index_to_prior_qtr == 50.0


def test_firm_concentration(spark):
    e = events(spark, *[(40, "N", "C", "a")] * 10, (40, "N", "C", "b"), (41, "N", "C", "b"),
               (41, "N", "C", "c"), (41, "N", "C", None))
    r = cnt.firm_concentration(e).first()
    assert (r.firms, r.cancels, r.avg_per_firm, r.firms_many, r.firms_one) == (3, 13, 13 / 3, 1, 1)


LONG = "metric string, fy int, qtr int, team string, week int, value double"


def test_indexes(spark):
    a = spark.createDataFrame([("m", 26, 4, "N", 40, 10.0), ("m", 26, 4, "M", 40, 5.0), ("m", 26, 4, "N", 41, 20.0)], LONG)
    f = spark.createDataFrame([("m", 26, 4, "N", 40, 20.0), ("m", 26, 4, "N", 41, 20.0), ("m", 26, 4, "M", 41, 0.0)], LONG)
    p = spark.createDataFrame([("m", 26, 4, "N", 40, 5.0)], LONG)
    w = weeks(spark)
    got = {(r.team, r.week): r for r in kpi.index_metrics(a, f, p, w).collect()}
    n = got["N", 41]
    assert (n.variance, n.itf, n.itpy, n.actual_qtd, n.itf_qtd, n.itpy_qtd) == (0.0, 100.0, None, 30.0, 75.0, 600.0)
    assert got["M", 40].itf is None and got["M", 41].actual == 0.0 and got["M", 41].itf is None
    assert (got["TOTAL", 40].actual, got["TOTAL", 40].forecast, got["TOTAL", 40].itf) == (15.0, 20.0, 75.0)
    card = report.team_scorecard(kpi.index_metrics(a, f, p, w), 40, {"m": ("actual", "itf"), "gone": ("actual",)})
    lines = {(r.team, r.measure): (r.this_week, r.qtd) for r in card.collect()}
    assert lines["N", "itf"] == (50.0, 50.0) and ("N", "itpy") not in lines
    empty = kpi.index_metrics(a.withColumn("value", F.lit(None).cast("double")), f, p, w)
    only = report.team_scorecard(empty, 40, {"m": ("itf",)})
    assert {r.team for r in only.collect()} == {"N", "TOTAL"}          # team M has no figure at all
    s = report.template_summary(kpi.index_metrics(a, f, p, w), 40, "m", ["N", "M"]).first()
    assert (s.total_variance, s.at_or_over, s.below) == ("-5", "M", "N")


def weeks(spark):
    return spark.createDataFrame([(26, 4, w) for w in (40, 41, 42)], "fy int, qtr int, week int")


def test_a_team_without_a_sale_this_week_keeps_its_figures_to_date(spark):
    a = spark.createDataFrame([("m", 26, 4, "N", 40, 10.0), ("m", 26, 4, "M", 42, 5.0),
                               ("m", 26, 4, "M", None, 3.0)], LONG)
    none = a.limit(0)
    index = kpi.index_metrics(a, none, none, weeks(spark))
    got = {(r.team, r.week): (r.actual, r.actual_qtd) for r in index.collect()}
    assert len(got) == 3 * 3 + 2 and got["N", 42] == (0.0, 10.0)
    card = report.team_scorecard(index, 42, {"m": ("actual",)})
    assert {r.team: r.qtd for r in card.collect()}["N"] == 10.0
    c = cnt.week_team_type_counts(events(spark, *SALES))
    attach = {(r.week, r.team) for r in kpi.attach_rate(c, "P", "S", weeks(spark)).collect()}
    assert {(w, "TOTAL") for w in (40, 41, 42)} <= attach


def test_mix_attach_combined(spark):
    c = cnt.week_team_type_counts(events(spark, *SALES))
    mix = {(r.fweek, r.team): r.share for r in kpi.mix_share(c, "P", "S").collect()}
    assert mix[42, "M"] == 0.0 and mix[42, "TOTAL"] == 1 / 6
    attach = {(r.week, r.team): r.attach_qtd for r in kpi.attach_rate(c, "P", "S", weeks(spark)).collect()}
    assert attach[42, "TOTAL"] == 1 / 9 and attach[42, "M"] == 1.0
    both = {(r.fweek, r.team): r.combined_n for r in kpi.combined_sales_upgrades(c, "S", "C").collect()}
    assert both[42, "N"] == 7 and both[42, "TOTAL"] == 8


def test_cancel_tables(spark):
    e = events(spark, (40, "N", "C", "a", "active_cancel"), (40, "N", "C", "a", "passive_cancel"),
               (40, "M", "C", "a", "reactivation"), (41, "M", "C", "a", "active_cancel"))
    plan = spark.createDataFrame([(26, 4, 42, 7.0)], "fy int, qtr int, fweek int, forecast double")
    got = {r.fweek: (r.active, r.passive, r.reactivated, r.total_cancels, r.forecast)
           for r in report.cancel_breakdown(e, plan).collect()}
    assert got == {40: (1, 1, 1, 1, None), 41: (1, 0, 0, 1, None), 42: (0, 0, 0, 0, 7.0)}
    teams = {(r.fweek, r.team): r.n for r in report.cancels_by_team(e).collect()}
    assert teams == {(40, "N"): 1, (40, "TOTAL"): 1, (41, "M"): 1, (41, "TOTAL"): 1}


def test_validate(spark):
    expected = spark.createDataFrame([("S", 40, "N", 2), ("S", 40, "M", 2), ("S", 42, "N", 5), ("S", 42, "Z", 0)],
                                     "table_type string, week int, label string, expected bigint")
    got = {(r.week, r.label): (r.actual, r.ok, r.all_ok)
           for r in report.validate_expected(events(spark, *SALES), expected).collect()}
    assert got == {(40, "N"): (2, True, False), (40, "M"): (1, False, False),
                   (42, "N"): (5, True, True), (42, "Z"): (0, True, True)}
    mapped = report.validate_expected(events(spark, *SALES), spark.createDataFrame(
        [("S", 40, "all", 3)], expected.schema), {"N": "all", "M": "all"})
    assert mapped.first().ok


def test_freshness(spark):
    meta = spark.createDataFrame([("2026-05-05 02:00:00",), ("2026-05-04 10:00:00",)], "t string").select(
        F.col("t").cast("timestamp_ntz").alias("finished_at"))
    assert report.freshness_check(meta, D(2026, 5, 4), "America/Toronto").first().fresh
    assert report.freshness_check(meta, D(2026, 5, 5), "UTC").first().fresh
    assert not report.freshness_check(meta.filter("false"), D(2026, 5, 5), "UTC").first().fresh


def facts(spark, *rows):
    e = events(spark, *rows)
    series = cnt.weekly_series(e)
    cells = cnt.cell_counts(e).withColumnRenamed("team", "label")
    got = report.narrative_facts(series, cells.filter("table_type = 'S'"), cells.filter("table_type = 'C'"),
                                 "S", "C", [("S", "Sales"), ("P", "Payroll")], ["N", "M"], ["N", "M"])
    return [(r.block, r.line_no, r.fact) for r in got.orderBy("block", "line_no").collect()]


def test_narrative(spark):
    assert facts(spark, *SALES) == [
        (1, 0, "N: 5 this week (last week 2, WoW +3)"), (1, 1, "M: 0 this week (last week 1, WoW -1)"),
        (2, 0, "Sales: 6 this week, WoW +3; QTD 9"), (2, 1, "Payroll: 1 this week, WoW +1; QTD 1"),
        (3, 0, "N: 2"), (4, 0, "Total by week: W41: 2, W42: 2"), (4, 1, "Quarter weekly average: 2"),
        (4, 2, "This week (W42): 2 (WoW +2; vs quarter average 0)"),
        (4, 3, "Best week (fewest): W41 (2); Worst week (most): W41 (2)")]
    assert facts(spark, (40, "N", "S")) == [
        (1, 0, "N: 1 this week"), (1, 1, "M: 0 this week"), (2, 0, "Sales: 1 this week; QTD 1"),
        (2, 1, "Payroll: 0 this week; QTD 0"), (3, 0, "(none)"), (4, 0, "(no data)")]
    assert facts(spark, (40, "N", "P")) == []


# -- forecast ------------------------------------------------------------------------------------------


def test_unpivot(spark, rows, caplog):
    wide = spark.createDataFrame([("2026", "4", "40", "1,5", "2"), (" ", "4", "41", "9", "9"), (None, "4", "41", "9", "9"),
                                  ("2026", "4", "42", None, "abc"), ("x", "4", "43", "7", "8")],
                                 "year_fy string, quarter_fy string, Week_FY string, A string, B string")
    got = fc.forecast_unpivot(wide, {"A": "a", "B": "b", "C": "c"})
    assert rows(got) == sorted([(2026, 4, 40, "a", 0.0), (2026, 4, 40, "b", 2.0), (2026, 4, 42, "a", 0.0),
                                (2026, 4, 42, "b", 0.0), (None, 4, 43, "a", 7.0), (None, 4, 43, "b", 8.0)], key=repr)
    assert "'C'" in caplog.text
    with pytest.raises(ValueError):
        fc.forecast_unpivot(wide, {"Z": "z"})


def test_motion_nulls(spark):
    rules = MotionRules("D", ["1"])
    cases = [("D", "1", "SELF"), ("D", "2", "AGENT"), ("D", None, "SELF"), ("X", "1", "SELF"), ("X", "1", "AGENT"),
             ("X", "1", None), (None, "2", "SELF")]
    df = spark.createDataFrame(cases, "d string, o string, c string")
    got = [r[0] for r in df.select(fc.motion_type(F.col("d"), F.col("o"), F.col("c"), rules)).collect()]
    assert got == ["Agent Added", "Runrate", "Agent Added", "Runrate", "Agent Added", "Agent Added", "Agent Added"]


def test_product_group_order(spark):
    rules = OpportunityRules(groups=(("adv", "A"), ("pay", "P")), groups_after_null=(("sheet", "T"),))
    df = spark.createDataFrame([("Pay ADV",), ("pay",), (None,), ("Sheets",), ("x",)], "n string")
    assert [r[0] for r in df.select(fc.product_group(F.col("n"), rules)).collect()] == ["A", "P", "No Product Line", "T", "Core"]


def test_live_lines(spark, rows):
    df = spark.createDataFrame([(1, None, "a"), (2, True, "a"), (3, False, "Upgrade x"), (4, False, None), (5, False, "b")],
                               "i int, isdeleted boolean, price_name string")
    assert rows(fc.filter_live_lines(df).select("i")) == [(1,), (5,)]


PIPE = "id bigint, team string, close_date date, iswon boolean, isclosed boolean, opp_status string"


def pipeline(spark):
    return spark.createDataFrame([
        (1, "N", D(2026, 5, 5), True, True, "Closed"), (1, "N", D(2026, 5, 5), True, True, "Closed"),
        (2, "N", D(2027, 5, 5), False, True, "Closed"), (3, "N", D(2026, 1, 1), False, True, "Closed"),
        (4, "M", D(2026, 5, 5), False, False, "Open"), (4, "M", D(2026, 5, 5), None, None, "Open"),
        (5, "M", D(2025, 5, 5), False, False, "Open")], PIPE)


def test_conversion(spark, rows):
    as_of = D(2026, 5, 5)
    assert rows(fc.conversion_rate(pipeline(spark), as_of)) == [("M", 0.0), ("N", 2 / 3)]
    assert rows(fc.conversion_rate(pipeline(spark), as_of, distinct_ids=True)) == [("M", 0.0), ("N", 0.5)]
    assert rows(fc.open_opportunities(pipeline(spark))) == [("M", 2)]
    assert rows(fc.pipeline_measures(pipeline(spark), as_of)) == [("M", 0.0, 2), ("N", 2 / 3, 0)]


def test_team_summary(spark):
    """All 22 measures of a hand-computed team, and zeros where a team has no sales."""
    base = spark.createDataFrame(
        [("N", 1, "Runrate", "core", True, True), ("N", 1, "Agent Added", "core", True, True),
         ("N", 2, "Agent Added", "core", True, True), ("N", 3, "Runrate", "core", False, True),
         ("N", 4, "Runrate", "other", True, False), ("N", None, "Runrate", "core", True, True)],
        "team string, account_id bigint, motion string, product_family string, in_qtd boolean, in_recent boolean")
    plan = spark.createDataFrame([(2026, 4, 40, "N", 3.0), (2026, 4, 41, "N", 2.0), (2026, 4, 50, "N", 5.0),
                                  (2026, 4, 40, "Z", 1.0), (2025, 4, 40, "N", 99.0)],
                                 "fy int, qtr int, week int, team string, forecast double")
    products = ProductRules("adv", "core", ("pay",), "pay")
    got = {r.team: r for r in fc.team_forecast_summary(
        base, products, pipeline(spark), plan, FiscalRule(), D(2026, 5, 5)).collect()}
    n = got["N"].asDict()
    assert len(n) == 23
    rr = 2 / 13
    want = dict(qtd_sales=3.0, qtd_forecast=5.0, qtd_itf=0.6, qtd_runrate_sales=2.0, qtd_pipeline_sales=1.0,
                qtd_rr_pct=2 / 3, qtd_runrate_forecast=3.0, qtd_forecast_rr_pct=0.6, qtd_runrate_itf=2 / 3,
                qtd_pipeline_forecast=2.0, qtd_pipeline_itf=0.5, qtg_sales=7.0, qtg_open_opps=0.0,
                opp_conv_rate=2 / 3, avg_weekly_rr=rr, qtg_fcst_runrate=float(round(rr * 87 / 7)),
                qtg_fcst_opps=0.0, qtg_fcst_sales=2.0, total_finance_fcst=10.0, total_fcst_sales=5.0,
                fcst_gap=-5.0, fcst_itf=0.5)
    assert {k: pytest.approx(v) for k, v in want.items()} == {k: n[k] for k in want}
    assert got["Z"].qtd_sales == 0.0 and got["Z"].qtg_sales == 1.0 and got["M"].qtg_open_opps == 2.0
