import datetime as dt

import pytest

from fiscalweave.functions.calendar import FiscalRule
from fiscalweave.operators import calendar as cal
from fiscalweave.operators import kpi, report
from fiscalweave.operators import state as st

D = dt.date

WEEK_GRID = ("section STRING, table_type STRING, label STRING, fy INT, qtr INT, week INT, "
             "value DOUBLE, state STRING, is_manual BOOLEAN")


@pytest.fixture(scope="module")
def weeks(spark):
    days = cal.date_spine(spark, D(2025, 8, 1), D(2027, 7, 31))
    return cal.calendar_weeks(cal.fiscal_calendar(days, FiscalRule()), 2026, 2027).cache()


def caps(spark, cap=45, reliable=True):
    return spark.createDataFrame([(2026, 4, cap, reliable)], "fy int, qtr int, cap int, reliable boolean")


def cell(**kw):
    base = dict(section="S", table_type="T", label="a", fy=2026, qtr=4, week=44, value=9.0,
                state="forecast", is_manual=False)
    return tuple((base | kw).values())


def grid(spark, *cells):
    return spark.createDataFrame([cell(**k) for k in cells], WEEK_GRID)


def counts(spark, *rows):
    return spark.createDataFrame([(2026, 4, *r) for r in rows],
                                 "fy int, qtr int, fweek int, team string, table_type string, n bigint")


def test_week_cap(weeks, rows):
    got = dict(((r.fy, r.qtr), (r.cap, r.reliable)) for r in st.week_cap(weeks, weeks, D(2026, 6, 3)).collect())
    assert got[(2026, 3)] == (st.ALL_WEEKS, True) and got[(2027, 1)] == (st.NO_WEEK, True)
    assert got[(2026, 4)][0] == FiscalRule().position(D(2026, 6, 3))[2]
    forced = st.week_cap(weeks, weeks, D(2026, 6, 3), override=50)
    assert {(r.cap, r.reliable) for r in forced.collect()} == {(50, True)}
    lost = st.week_cap(weeks, weeks.filter("false"), D(2026, 6, 3))
    assert {(r.cap, r.reliable) for r in lost.collect()} == {(st.ALL_WEEKS, False)}


@pytest.mark.parametrize(("case", "n", "zeros", "reliable", "want"), [
    (dict(), 3, False, True, (3.0, "actual", True, True)),
    (dict(), 0, False, True, (9.0, "forecast", False, False)),
    (dict(), 0, True, True, (0.0, "actual", True, True)),
    (dict(), 0, True, False, (9.0, "forecast", False, False)),
    (dict(state="actual"), 0, False, True, (0.0, "actual", False, True)),
    (dict(week=46, state="actual"), 3, False, True, (9.0, "forecast", False, False)),
    (dict(week=46), 3, True, True, (9.0, "forecast", False, False)),
    (dict(is_manual=True), 3, False, True, (9.0, "forecast", False, True)),
    (dict(is_manual=True, week=46, state="actual"), 3, False, True, (9.0, "actual", False, True)),
    (dict(week=None), 3, False, True, (9.0, "forecast", False, True)),
])
def test_actual_or_forecast(spark, case, n, zeros, reliable, want):
    got = st.actual_or_forecast(
        grid(spark, case), counts(spark, (case.get("week", 44), "a", "T", n)) if n else counts(spark),
        caps(spark, reliable=reliable), ["T"] if zeros else []).first()
    assert (got.value, got.state, got.changed, got.resolved) == want


@pytest.mark.parametrize(("case", "want"), [
    (dict(), ("actual", True, True)), (dict(value=0.0), ("forecast", False, False)),
    (dict(value=None), ("forecast", False, False)), (dict(state="actual", value=0.0), ("actual", False, True)),
    (dict(week=46, state="actual"), ("forecast", False, False)),
    (dict(week=None), ("actual", True, True)), (dict(is_manual=True), ("forecast", False, True)),
    (dict(is_manual=True, week=50, state="actual"), ("actual", False, True)),
])
def test_resolve_state_only(spark, case, want):
    got = st.resolve_state_only(grid(spark, case), caps(spark)).first()
    assert (got.state, got.changed, got.resolved, got.value) == (*want, case.get("value", 9.0))


@pytest.mark.parametrize(("case", "reliable", "want"), [
    (dict(), True, "actual"), (dict(), False, "forecast"), (dict(week=46), True, "forecast"),
    (dict(is_manual=True), True, "forecast"), (dict(week=None), True, "forecast"),
    (dict(state="actual"), False, "actual")])
def test_close_through_cap(spark, case, reliable, want):
    assert st.close_through_cap(grid(spark, case), caps(spark, reliable=reliable)).first().state == want


def test_flags_and_audit(spark, rows):
    g = grid(spark, dict(), dict(label="b"), dict(week=43), dict(label="b", week=43), dict(week=None))
    done = st.actual_or_forecast(g, counts(spark, (44, "a", "T", 1), (43, "a", "T", 1), (43, "b", "T", 2)),
                                 caps(spark))
    assert rows(st.completed_week_flags(done)) == [(2026, 4, 43, True), (2026, 4, 44, False)]
    audit = [(r.status, r.label, r.week) for r in st.transition_audit(done).collect()]
    assert sorted(audit) == [("flipped", "a", 43), ("flipped", "a", 44), ("flipped", "b", 43),
                             ("still_forecast", "b", 44)]


def test_rollover_then_future_cap(spark, weeks):
    src = grid(spark, *[dict(label="FY26 Q4 a", week=w, value=float(w), state="actual") for w in (40, 41)],
               dict(label="hand", week=40, is_manual=True, state="actual"), dict(label="FY25 Q4 x", week=40))
    new = st.quarter_rollover(src, weeks, 2026, 4)
    by = {(r.label, r.week): r for r in new.collect()}
    assert len(by) == 3 * 14
    assert (by["FY27 Q1 a", 1].value, by["FY27 Q1 a", 1].state) == (40.0, "forecast")
    assert by["FY27 Q1 a", 3].value is None
    assert by["hand", 1].state == "actual"
    assert by["FY25 Q4 x", 1].needs_review and not by["FY27 Q1 a", 1].needs_review
    assert (by["FY27 Q1 a", 1].week_header, by["FY27 Q1 a", 1].day_label) == ("W1 Aug 1-1", "1 days")
    assert (by["FY27 Q1 a", 2].week_header, by["FY27 Q1 a", 2].day_label) == ("W2", "")
    future = st.week_cap(new, weeks, D(2026, 6, 3))
    state = st.actual_or_forecast(new.select(*[c.split()[0] for c in WEEK_GRID.split(", ")]), counts(spark), future)
    assert {r.state for r in state.collect() if not r.is_manual} == {"forecast"}
    with pytest.raises(ValueError, match="0 weeks"):
        st.quarter_rollover(src, weeks, 2027, 4)
    with pytest.raises(ValueError, match="14 weeks"):
        st.quarter_rollover(src, weeks, 2026, 4, max_weeks=13)


def test_week_gap(spark):
    def fill(*labels, **kw):
        df = spark.createDataFrame([("s", i, v) for i, v in enumerate(labels)], "sheet string, pos int, label string")
        return [r.week for r in st.fill_week_gap(df, **kw).orderBy("pos").collect()]

    assert fill("W51", "", "W53") == [51, 52, 53]
    assert fill("W40 May 1-2", "", "", "W43") == [40, None, None, 43]
    assert fill("", "WK1", "", "WK3", "", "WK5", "") == [None, 1, 2, 3, 4, 5, None]
    assert fill("x", "", first_week=40) == [40, 41] and fill("x", "") == [None, None]


def test_qtd_plus_qtg_is_the_quarter(spark):
    g = grid(spark, *[dict(week=w, value=v) for w, v in ((40, 1.0), (45, 2.0), (46, 4.0), (47, None), (None, 99.0))])
    r = kpi.qtd_qtg(g, 45).first()
    assert (r.qtd, r.qtg, r.quarter_total, r.qtd_average) == (3.0, 4.0, 7.0, 1.5)
    assert r.qtd + r.qtg == r.quarter_total
    wide = report.week_grid(g, [40, 41, 45, 46, 47], 45).first()
    assert (wide.w40, wide.w41, wide.w45, wide.w46, wide.quarter_total) == (1.0, None, 2.0, 4.0, 7.0)


def test_grid_of_a_first_quarter_and_a_week_without_a_column(spark):
    rule = FiscalRule()
    assert rule.weeks(2027, 1)[0] == 1 and len(rule.weeks(2027, 1)) == 14
    assert rule.weeks(2026, 4) == list(range(40, 54))
    g = grid(spark, dict(fy=2027, qtr=1, week=2, value=5.0))
    row = report.week_grid(g, rule.weeks(2027, 1), 3).first()
    assert (row.w2, row.w14, row.qtd) == (5.0, None, 5.0)
    with pytest.raises(Exception, match="week without a column: 2"):
        report.week_grid(g, rule.weeks(2026, 4), 45).collect()


def test_scenarios(spark):
    g = grid(spark, dict(week=40, value=3.0), dict(week=50, value=4.0))
    inputs = spark.createDataFrame([("S", "a", 2026, 4, s, v) for s, v in (("best", 9.0), ("target", 8.0))],
                                   "section string, label string, fy int, qtr int, scenario string, value double")
    r = kpi.scenario_table(inputs, kpi.qtd_qtg(g, 45)).first()
    assert (r.best, r.most_likely, r.target, r.qtd, r.qtg, r.delta) == (9.0, None, 8.0, 3.0, 4.0, -1.0)
