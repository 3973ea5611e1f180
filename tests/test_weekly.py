"""The weekly run end to end on the driver's smallest tables, over two weeks."""

import dataclasses
import datetime as dt

from conftest import SF
from pyspark.sql import functions as F

from fiscalweave.plans import binding as b
from fiscalweave.plans.weekly import WeeklyConfig, WeeklyInputs, WeeklyTarget, run_week


def config(as_of):
    return WeeklyConfig(
        as_of=as_of, tags=b.TAG_RULES, regions=b.REGIONS, teams=b.TEAMS,
        excluded_firms=b.EXCLUDED_FIRMS, cancels=b.CANCELS, owners=b.OWNERS,
        toplines=[("SALES", "Total sales"), ("PAYROLL", "Payroll")],
        cancel_labels=["Alpha", "Beta", "Gamma", "Delta", "Echo", "Unmanaged"])


def cancel_rows(spark, target):
    df = target.read(spark, "weekly_events").filter("table_type = 'CANCELS'")
    return sorted((r.fweek, r.account_id, r.team_raw) for r in df.collect())


def test_two_runs(spark, tmp_path):
    t, target = b.Tables(spark, SF), WeeklyTarget(str(tmp_path))
    inputs = WeeklyInputs(t.bookings, t.agents, t.account_status, t.company_status, t.accounts,
                          t.owner_history, t.users, t.roster)
    # Every account that has cancelled by then, so that there is something to freeze.
    wide = config(dt.date(2000, 6, 15))
    everywhere = dataclasses.replace(wide, cancels=dataclasses.replace(
        b.CANCELS, countries=[f"NATION_{i}" for i in range(25)],
        channels=["1-URGENT", "2-HIGH", "3-MEDIUM"]))
    n = {r.table_type: r.n for r in run_week(inputs, everywhere, target, "w46").collect()}
    assert n["SALES"] == 22 and n["CANCELS"] > 0
    first = cancel_rows(spark, target)
    assert len(first) == n["CANCELS"]

    # A week later all older cancels are dated one day on, so old weeks would drift.
    late = t.company_status.filter(F.col("cancel_date") >= F.lit(dt.date(2000, 6, 11))).unionByName(
        t.company_status.filter(F.col("cancel_date") < F.lit(dt.date(2000, 6, 11))).withColumn(
            "cancel_date", F.date_add("cancel_date", 1)))
    later = dataclasses.replace(inputs, company_status=late)
    run_week(later, dataclasses.replace(everywhere, as_of=dt.date(2000, 6, 22)), target, "w47")
    second = cancel_rows(spark, target)
    closed = {w for w, _, _ in first if w < 46}
    assert [r for r in second if r[0] in closed] == [r for r in first if r[0] in closed]

    meta = {r.run_id: r for r in target.run_meta(spark).collect()}
    assert meta.keys() == {"w46", "w47"} and "Total sales: " in meta["w46"].summary_text
    assert target.calendar_weeks(spark).filter("fy = 2001").count() > 52


def small(spark):
    t = b.Tables(spark, SF)
    inputs = WeeklyInputs(t.bookings, t.agents, t.account_status, t.company_status, t.accounts,
                          t.owner_history, t.users, t.roster)
    wide = config(dt.date(2000, 6, 15))
    return inputs, dataclasses.replace(wide, cancels=dataclasses.replace(
        b.CANCELS, countries=[f"NATION_{i}" for i in range(25)],
        channels=["1-URGENT", "2-HIGH", "3-MEDIUM"]))


def stored(spark, target):
    df = target.read(spark, "freeze_store")
    return sorted((r.fweek, r.account_id, r.team_raw) for r in df.collect())


def test_failures_and_repeats_keep_the_store(spark, tmp_path, monkeypatch):
    from fiscalweave.plans import weekly
    from fiscalweave.sources import sinks

    inputs, settings = small(spark)
    target = WeeklyTarget(str(tmp_path))
    run_week(inputs, settings, target, "w46")
    locked, shown = stored(spark, target), cancel_rows(spark, target)
    assert locked

    def broken(*args, **kw):
        raise RuntimeError("no freeze today")

    later = dataclasses.replace(settings, as_of=dt.date(2000, 6, 22))
    with monkeypatch.context() as m:  # (a) a failing freeze, calendar and summary
        for name in ("weekly_freeze", "summary_text"):
            m.setattr(weekly, name, broken)
        run_week(inputs, later, target, "w47")
    assert stored(spark, target) == locked and len(cancel_rows(spark, target)) >= len(shown)
    meta = {r.run_id: r for r in target.run_meta(spark).collect()}
    assert meta["w47"].store_attempt is None and meta["w47"].summary_text == ""

    run_week(inputs, settings, target, "w46")  # (b) a committed run once more
    assert stored(spark, target) == locked

    with monkeypatch.context() as m:  # (c) a crash before the commit, then a retry
        m.setattr(sinks, "append_run_meta", broken)
        try:
            run_week(inputs, later, target, "w48")
        except RuntimeError:
            pass
    assert stored(spark, target) == locked
    run_week(inputs, later, target, "w48")
    assert set(locked) <= set(stored(spark, target))

    # (d) a tag without rows the second time is not read from the first
    none = dataclasses.replace(settings, tags=[r for r in b.TAG_RULES if r.tag == "SALES"])
    run_week(inputs, none, target, "w48")
    tags = {r.table_type for r in target.read(spark, "weekly_events").select("table_type").collect()}
    assert tags <= {"SALES", "CANCELS"}
