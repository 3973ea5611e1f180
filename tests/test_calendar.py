import datetime as dt

import pytest
from hypothesis import given
from hypothesis import strategies as some
from pyspark.sql import functions as F

from fiscalweave.functions.calendar import FiscalRule
from fiscalweave.operators import calendar as cal

RULE = FiscalRule()
D = dt.date


def weeks(spark, rule=RULE):
    days = cal.date_spine(spark, D(2024, 8, 1), D(2027, 7, 31))
    return cal.calendar_weeks(cal.fiscal_calendar(days, rule), 2025, 2027)


def test_golden_week_lengths(spark):
    w = weeks(spark)
    q4 = {r.week: r.day_count_in_qtr for r in w.filter("fy = 2026 AND qtr = 4").collect()}
    assert q4 == {40: 2, **{n: 7 for n in range(41, 53)}, 53: 6}
    q1 = {r.week: r.day_count_in_qtr for r in w.filter("fy = 2027 AND qtr = 1").collect()}
    assert len(q1) == 14 and q1[1] == 1


def test_split_week_belongs_to_both_quarters(spark):
    assert {r.qtr for r in weeks(spark).filter("fy = 2026 AND week = 40").collect()} == {3, 4}


@pytest.mark.parametrize("rule", [RULE, FiscalRule(1, 2), FiscalRule(4, 7), FiscalRule(10, 1)])
def test_scalars_and_columns_agree(spark, rule):
    days = cal.date_spine(spark, D(2023, 12, 20), D(2026, 1, 10))
    for r in cal.fiscal_calendar(days, rule).collect():
        assert (r.fy, r.qtr, r.week) == rule.position(r.date)
        first, last = rule.bounds(r.fy, r.qtr)
        assert first <= r.date <= last


@given(some.integers(1, 12), some.integers(2000, 2040))
def test_bounds_tile_the_year(month, fy):
    rule = FiscalRule(month)
    spans = [rule.bounds(fy, q) for q in (1, 2, 3, 4)]
    assert (spans[0][0], spans[-1][1]) == rule.bounds(fy)
    for (_, end), (start, _) in zip(spans, spans[1:]):
        assert start == end + dt.timedelta(days=1)
    assert rule.bounds(fy)[1] + dt.timedelta(days=1) == rule.bounds(fy + 1)[0]


def test_ages(spark):
    ext = cal.date_ext(cal.date_spine(spark, D(2025, 7, 1), D(2026, 6, 30)), RULE, D(2026, 5, 5))
    got = {r.date: (r.fiscal_year_age, r.fiscal_qtr_age, r.week_age) for r in ext.collect()}
    assert got[D(2026, 5, 5)] == (0, 0, 0)
    assert got[D(2026, 5, 2)] == (0, 0, 1)      # Saturday before
    assert got[D(2026, 4, 30)] == (0, 1, 1)     # same week, previous quarter
    assert got[D(2025, 7, 31)] == (1, 4, 40)    # four quarters before
    assert got[D(2026, 5, 10)] == (0, 0, -1)
    row = ext.filter(F.col("date") == D(2026, 5, 5)).first()
    assert (row.qtr_start, row.qtr_end) == (D(2026, 5, 1), D(2026, 7, 31))


def test_current_week(spark, rows):
    w = weeks(spark)
    assert rows(cal.current_week(w, D(2026, 5, 2))) == [(2026, 4, 40)]
    assert rows(cal.current_week(w, D(2030, 1, 1))) == [(2027, 4, 53)]   # latest one started
    assert rows(cal.current_week(w, D(2020, 1, 1))) == []
    gap = w.filter("NOT (fy = 2026 AND week IN (44, 45))")
    assert rows(cal.current_week(gap, D(2026, 6, 3))) == [(2026, 4, 43)]


def test_progress(spark, rows):
    ext = cal.date_ext(cal.date_spine(spark, D(2026, 5, 1), D(2026, 7, 31)), RULE, D(2026, 5, 4))
    assert rows(cal.progress(ext, D(2026, 5, 4))) == [(2026, 4, 41, 1.0, 88 / 7)]
    assert rows(cal.progress(ext, D(2026, 7, 31))) == [(2026, 4, 53, 13.0, 0.0)]


def test_spine_is_bounded(spark):
    with pytest.raises(ValueError):
        cal.date_spine(spark, D(2026, 1, 2), D(2026, 1, 1))
    with pytest.raises(ValueError):
        cal.date_spine(spark, D(1, 1, 1), D(9999, 1, 1))
