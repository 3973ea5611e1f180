"""Counts that follow signed changes, against counting everything again."""

import datetime as dt
import random

import pytest
from conftest import SF
from pyspark.sql import functions as F

from fiscalweave.operators import counts, events
from fiscalweave.operators import incremental as inc
from fiscalweave.plans import binding as b
from fiscalweave.plans.increment import CountStore, apply_changes
from fiscalweave.sources.commits import CommitConflict

CHANGES = "fy int, qtr int, fweek int, team string, table_type string, event binary, change long"


def batch(spark, *rows):
    """Changes of (week, event, change), all of one team and type."""
    return spark.createDataFrame(
        [(26, 4, w, "A", "SALES", e.encode(), n) for w, e, n in rows], CHANGES)


def cells(store, spark, version=None):
    return {r.fweek: r.n for r in store.cells(spark, version).collect()}


def test_support_decides_what_counts(spark, tmp_path):
    store = CountStore(str(tmp_path))
    assert cells(store, spark) == {}
    apply_changes(store, batch(spark, (44, "x", 2), (44, "y", 1), (45, "x", 1)), "r", 26, 44)
    assert cells(store, spark) == {44: 2, 45: 1}
    apply_changes(store, batch(spark, (44, "x", -1), (44, "y", -1), (45, "z", 1)), "r", 26, 44)
    assert cells(store, spark) == {44: 1, 45: 2}
    # A reversal that comes before its insert, and one more of a row that is still there.
    apply_changes(store, batch(spark, (45, "late", -1), (44, "x", -1)), "r", 26, 44)
    assert cells(store, spark) == {45: 2}
    apply_changes(store, batch(spark, (45, "late", 1), (44, "x", 1)), "r", 26, 44)
    assert cells(store, spark) == {44: 1, 45: 2}
    assert cells(store, spark, 1) == {44: 2, 45: 1}  # an earlier version


def test_closed_weeks_hold(spark, tmp_path):
    store = CountStore(str(tmp_path))
    apply_changes(store, batch(spark, (43, "a", 1), (44, "b", 1), (45, "c", 1)), "r1", 26, 44)
    apply_changes(store, batch(spark, (43, "late", 1), (43, "a", -1), (44, "b2", 1), (42, "old", 1)),
                  "r2", 26, 45)
    # 43 was closed by r1; 42 had nothing to record, so it could still be filled; 44 was open.
    assert cells(store, spark) == {42: 1, 43: 1, 44: 2, 45: 1}
    apply_changes(store, batch(spark, (42, "more", 1), (44, "b3", 1), (45, "c2", 1)), "r3", 26, 46)
    assert cells(store, spark) == {42: 1, 43: 1, 44: 2, 45: 2}
    shut = {r.fweek: r.closed for r in store.pointers(spark).collect()}
    assert shut == {42: True, 43: True, 44: True, 45: True}
    apply_changes(store, batch(spark), "r4", 26, 46)  # nothing new
    assert cells(store, spark) == {42: 1, 43: 1, 44: 2, 45: 2}
    before = cells(store, spark)
    assert store.clean(spark) == [] and store.clean(spark, older_than=0) != []
    assert cells(store, spark) == before


def test_a_run_reads_the_weeks_it_touches(spark, tmp_path):
    store = CountStore(str(tmp_path))
    apply_changes(store, batch(spark, *[(w, "e", 1) for w in range(40, 50)]), "r1", 26, 40)
    changes = batch(spark, (47, "f", 1))
    touched = store.pointers(spark).join(F.broadcast(changes.select(*inc.WEEK).distinct()),
                                         list(inc.WEEK), "left_semi")
    assert {r.fweek for r in store.support(spark, touched).collect()} == {47}
    plan = store.support(spark, touched)._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert len(filters) == 1 and "fweek" in filters[0] and "(fweek" in filters[0].split("PushedFilters")[0]


def test_two_runs_on_one_state(spark, tmp_path, monkeypatch):
    store = CountStore(str(tmp_path))
    apply_changes(store, batch(spark, (45, "a", 1)), "r1", 26, 45)
    plain, nested = inc.fold, []

    def slow(*args):
        if not nested:
            nested.append(True)
            apply_changes(store, batch(spark, (45, "b", 1)), "other", 26, 45)
        return plain(*args)

    monkeypatch.setattr(inc, "fold", slow)
    with pytest.raises(CommitConflict):
        apply_changes(store, batch(spark, (45, "c", 1)), "late", 26, 45)
    assert cells(store, spark) == {45: 2}
    apply_changes(store, batch(spark, (45, "c", 1)), "late", 26, 45)
    assert cells(store, spark) == {45: 3}


def test_equal_to_a_full_count(spark, tmp_path):
    t, store = b.Tables(spark, SF), CountStore(str(tmp_path))
    rnd = random.Random(4)
    rows = t.materialize(events.in_period(t.bookings, "event_date", b.RULE, b.FY, 4), "rows")
    rows = t.materialize(rows.unionByName(rows.filter("l_orderkey % 3 = 0")), "rows")  # repeated
    part = F.pmod(F.xxhash64("l_orderkey", "offer_key"), F.lit(7))
    runs = [[(p, 1)] for p in range(7)] + [[(2, -1)], [(2, 1), (5, -1)]]
    rnd.shuffle(runs)
    for i, run in enumerate(runs):
        signed = None
        for p, sign in run:
            some = rows.filter(part == p).withColumn("change", F.lit(sign))
            signed = some if signed is None else signed.unionByName(some)
        apply_changes(store, inc.event_changes(signed, t.agents, b.RULE, b.TAG_RULES, b.FY, 4,
                                               b.TEAMS, b.EXCLUDED_FIRMS), f"r{i}", b.FY, 1)
    left = events.weekly_events(rows.filter(part != 5), t.agents, b.RULE, b.TAG_RULES, b.REGIONS,
                                b.FY, 4, b.TEAMS, b.EXCLUDED_FIRMS)
    get = lambda df: sorted(tuple(r) for r in df.select(*inc.CELL, "n").collect())
    want = get(counts.cell_counts(left))
    assert want and get(store.cells(spark)) == want
    assert b.RULE.position(dt.date(2000, 6, 15))[2] == 46
