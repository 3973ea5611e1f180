import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as some

from fiscalweave.operators.freeze import weekly_freeze
from fiscalweave.schemas import WEEKLY_EVENTS, conform
from fiscalweave.sources import sinks


def frame(spark, rows):
    """Events from (fy, qtr, week, account)."""
    df = spark.createDataFrame(rows, "fy int, qtr int, fweek int, account_id string")
    return conform(df, WEEKLY_EVENTS)


def short(df):
    return sorted((r.fy, r.qtr, r.fweek, r.account_id) for r in df.collect())


STORE = [(26, 4, 41, "a"), (26, 4, 43, "b"), (26, 4, 47, "stale"), (26, 3, 30, "old")]
FRESH = [(26, 4, 41, "late"), (26, 4, 42, "c"), (26, 4, 44, "d"), (26, 4, 45, "e"),
         (26, 4, None, "lost"), (26, 4, 47, "f")]


def test_merge(spark):
    out = weekly_freeze(frame(spark, STORE), frame(spark, FRESH), 26, 4, 45)
    assert short(out.events) == [(26, 4, 41, "a"), (26, 4, 42, "c"), (26, 4, 43, "b"),
                                 (26, 4, 44, "d"), (26, 4, 45, "e"), (26, 4, 47, "f")]
    assert short(out.store) == [(26, 3, 30, "old"), (26, 4, 41, "a"), (26, 4, 42, "c"),
                                (26, 4, 43, "b"), (26, 4, 44, "d")]


def test_quarter_over_and_empty_store(spark):
    out = weekly_freeze(frame(spark, []), frame(spark, FRESH), 26, 4, None)
    assert short(out.events) == short(out.store) == sorted(r for r in FRESH if r[2])


def test_closed_week_without_rows_can_fill_later(spark):
    first = weekly_freeze(frame(spark, []), frame(spark, []), 26, 4, 45)
    second = weekly_freeze(first.store, frame(spark, [(26, 4, 41, "late")]), 26, 4, 45)
    assert short(second.store) == [(26, 4, 41, "late")]
    marked = weekly_freeze(first.store, frame(spark, [(26, 4, 41, "late"), (26, 4, 42, "new")]),
                           26, 4, 45, closed_weeks=frame(spark, [(26, 4, 41, None), (25, 4, 42, None)]))
    assert short(marked.store) == [(26, 4, 42, "new")]


EVENT = some.tuples(some.just(26), some.just(4), some.integers(40, 47), some.sampled_from("abc"))


@settings(max_examples=6, deadline=None)
@given(some.lists(EVENT, min_size=1, max_size=8), some.lists(EVENT, max_size=8))
def test_idempotent_and_closed_weeks_hold(spark, fresh, late):
    once = weekly_freeze(frame(spark, []), frame(spark, fresh), 26, 4, 44)
    twice = weekly_freeze(once.store, frame(spark, fresh), 26, 4, 44)
    assert short(twice.events) == short(once.events) and short(twice.store) == short(once.store)
    closed = {r[2] for r in short(once.store)}
    later = weekly_freeze(once.store, frame(spark, late), 26, 4, 44)
    assert [r for r in short(later.store) if r[2] in closed] == short(once.store)


def test_store_on_disk(spark, tmp_path):
    store, meta = str(tmp_path / "store"), str(tmp_path / "meta")

    def read():
        runs = sinks.run_log(spark, meta).read()
        return sinks.read_freeze(spark, store, runs, WEEKLY_EVENTS)

    for qtr in (3, 4):
        sinks.write_freeze(frame(spark, STORE), store, "r1", 26, qtr)
        sinks.append_run_meta(spark, meta, "r1", 26, qtr, dt.datetime(2026, 6, 1),
                              store_attempt="r1")
    assert short(read()) == sorted(STORE)
    new = weekly_freeze(read(), frame(spark, FRESH), 26, 4, 45)
    sinks.write_freeze(new.store, store, "r2", 26, 4)   # reads the store it extends
    assert short(read()) == sorted(STORE)               # not visible before its commit
    sinks.append_run_meta(spark, meta, "r2", 26, 4, dt.datetime(2026, 6, 8), "done",
                          store_attempt="r2")
    want = short(weekly_freeze(frame(spark, STORE), frame(spark, FRESH), 26, 4, 45).store)
    assert short(read()) == want
    sinks.write_freeze(new.store, store, "r2", 26, 4)   # a repeated write replaces its own run
    assert short(read()) == want
    latest = {r.qtr: (r.run_id, r.summary_text) for r in sinks.latest_run(sinks.run_log(spark, meta).read()).collect()}
    assert latest == {3: ("r1", ""), 4: ("r2", "done")}


def test_exports(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, 2.0, 2.5, dt.date(2026, 5, 1), None, True), (None, None, 1e17, None, "x", False)],
        "i int, d double, e double, day date, s string, b boolean")
    assert [tuple(r) for r in sinks.stringify(df).collect()] == [
        ("1", "2", "2.5", "2026-05-01", "", "true"), ("", "", "100000000000000000", "", "x", "false")]
    df = spark.createDataFrame([("t", 0.12345, 2.5), ("u", 0.0005, 3.5)], "team string, r double, m double")
    assert [tuple(r) for r in sinks.round_for_export(df, ["r"], ["team"]).collect()] == [
        ("t", 0.123, 2), ("u", 0.0, 4)]
    target = str(tmp_path / "snap")
    sinks.write_snapshot(spark.range(5), target)
    sinks.write_snapshot(spark.range(2), target)
    assert sinks.read_snapshot(spark, target).count() == 2


def test_sheet(spark, tmp_path):
    import pytest

    from fiscalweave.sources.tables import read_sheet

    (tmp_path / "s.csv").write_text("B,A,C\n1,x,2\n3,y\n4,,5\n , z ,6\n")
    sheet = read_sheet(spark, str(tmp_path / "s.csv"), ["A", "B"], key="A")
    assert sorted((r.A.strip(), r.B.strip(), r.C) for r in sheet.collect()) == [
        ("x", "1", "2"), ("y", "3", ""), ("z", "", "6")]
    with pytest.raises(ValueError):
        read_sheet(spark, str(tmp_path / "s.csv"), ["A", "Z"], key="A")
