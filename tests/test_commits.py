"""Numbered commits, two writers at a time, clean-up of dead attempts and snapshots that swap."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_weekly import cancel_rows, small, stored

from fiscalweave.plans import weekly
from fiscalweave.plans.weekly import WeeklyTarget, run_week
from fiscalweave.sources import commits, sinks

KV = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])


def log(spark, path):
    return commits.CommitLog(spark, str(path), KV, ("k",))


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), KV)


def test_one_of_two_commits_on_one_state_wins(spark, tmp_path):
    one = log(spark, tmp_path / "log")
    assert one.head() == 0 and one.read().collect() == []
    assert one.commit(rows(spark, (1, "a")), 0) == 1
    with pytest.raises(commits.CommitConflict):
        one.commit(rows(spark, (1, "b")), 0)
    assert one.commit(rows(spark, (2, "c")), 0) == 2          # about something else: goes on
    assert one.commit(rows(spark, (1, "b")), 1) == 3          # repeated on the new state
    assert one.commit(rows(spark, (1, "d"))) == 4             # depends on no state
    assert sorted((r.version, r.k, r.v) for r in one.read().collect()) == [
        (1, 1, "a"), (2, 2, "c"), (3, 1, "b"), (4, 1, "d")]
    assert one.read(2).count() == 2
    assert [n for n in os.listdir(tmp_path / "log") if n.startswith("_staged")] == []


def test_writers_at_the_same_time_get_numbers_of_their_own(spark, tmp_path):
    shared, got, lost = log(spark, tmp_path / "log"), [], []

    def write(k):
        try:
            got.append(shared.commit(rows(spark, (k, str(k))), 0))
        except commits.CommitConflict:
            lost.append(k)

    for keys in ([1] * 6, [2, 3, 4, 5]):
        writers = [threading.Thread(target=write, args=(k,)) for k in keys]
        for w in writers:
            w.start()
        for w in writers:
            w.join()
    assert sorted(got) == [1, 2, 3, 4, 5] and lost == [1] * 5
    assert sorted(r.k for r in shared.read().collect()) == [1, 2, 3, 4, 5]


def test_a_taken_name_is_refused(spark, tmp_path):
    for name in ("a", "b", "to"):
        rows(spark, (1, name)).write.parquet(str(tmp_path / name))
    assert not commits.create_by_rename(spark, str(tmp_path / "a"), str(tmp_path / "to"))
    assert spark.read.parquet(str(tmp_path / "to")).first().v == "to"
    assert commits.create_by_rename(spark, str(tmp_path / "a"), f"file://{tmp_path}/new")
    assert spark.read.parquet(str(tmp_path / "new")).first().v == "a"


def test_rename_on_other_file_systems(spark, tmp_path):
    """viewfs is not a local scheme, so this takes the way of a cluster's file system."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.tables.link./t", f"file://{tmp_path}")
    root = "viewfs://tables/t"
    one = commits.CommitLog(spark, f"{root}/log", KV, ("k",))
    assert one.commit(rows(spark, (1, "a")), 0) == 1
    with pytest.raises(commits.CommitConflict):
        one.commit(rows(spark, (1, "b")), 0)
    assert one.commit(rows(spark, (1, "b")), 1) == 2
    assert [r.v for r in one.read().orderBy("version").collect()] == ["a", "b"]


def test_of_two_runs_from_one_state_one_is_published(spark, tmp_path, monkeypatch):
    inputs, settings = small(spark)
    target = WeeklyTarget(str(tmp_path))
    run_week(inputs, settings, target, "w46")
    locked = stored(spark, target)
    # A second run of the quarter starts and commits while the first one is still counting.
    counted, nested = weekly.summary_text, []

    def slow(cells, config):
        if not nested:
            nested.append(True)
            run_week(inputs, settings, target, "other")
        return counted(cells, config)

    with monkeypatch.context() as m:
        m.setattr(weekly, "summary_text", slow)
        with pytest.raises(commits.CommitConflict):
            run_week(inputs, settings, target, "late")
    ids = [r.run_id for r in target.run_meta(spark).orderBy("version").collect()]
    assert ids == ["w46", "other"] and stored(spark, target) == locked
    run_week(inputs, settings, target, "late")  # repeated on the new state
    assert target.version(spark) == 3 and stored(spark, target) == locked


def attempts(target, table):
    return {a for a, _ in commits.attempts_below(target[0], target[1].path(table))}


def test_clean_up_deletes_what_no_run_names(spark, tmp_path, monkeypatch):
    inputs, settings = small(spark)
    target = WeeklyTarget(str(tmp_path))
    run_week(inputs, settings, target, "w46")

    def broken(*args, **kw):
        raise RuntimeError("dies before the commit")

    with monkeypatch.context() as m:
        m.setattr(sinks, "append_run_meta", broken)
        with pytest.raises(RuntimeError):
            run_week(inputs, settings, target, "dead")
    with monkeypatch.context() as m:  # publishes its events, but not the store
        m.setattr(weekly, "weekly_freeze", broken)
        run_week(inputs, settings, target, "w47")
    before = stored(spark, target), cancel_rows(spark, target)
    runs = {r.run_id: r.attempt for r in target.run_meta(spark).collect()}
    assert target.clean(spark) == []                       # all of them are young
    gone = target.clean(spark, older_than=0)
    assert any("dead-" in g for g in gone) and not any(runs["w47"] in g for g in gone)
    here = (spark, target)
    assert attempts(here, "freeze_store") == {runs["w46"]}  # the store has not moved since
    assert runs["w47"] in attempts(here, "weekly_events")
    assert (stored(spark, target), cancel_rows(spark, target)) == before
    assert target.clean(spark, older_than=0) == []


def test_snapshot_swaps_in_one_step(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "snap")
    with pytest.raises(ValueError):
        sinks.read_snapshot(spark, target)
    old = spark.range(10).withColumn("part", F.col("id") % 2)
    assert sinks.write_snapshot(old, target, ["part"]) == 1
    read = lambda v=None: sorted(tuple(r) for r in sinks.read_snapshot(spark, target, v).collect())
    first = read()
    assert first == [(i, i % 2) for i in range(10)]
    # A write that dies in a task, and one that dies between the data and the commit.
    torn = spark.range(0, 10, 1, 4).select(
        F.when(F.col("id") == 9, F.raise_error(F.lit("torn"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="torn"):
        sinks.write_snapshot(torn, target)
    with monkeypatch.context() as m:
        m.setattr(commits, "create_by_rename", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            sinks.write_snapshot(spark.range(3), target)
    assert read() == first
    # The new version may be made from the old one, and the old one is still there by its number.
    grown = sinks.read_snapshot(spark, target).filter("id > 4")
    assert sinks.write_snapshot(grown, target) == 2
    assert read() == [r for r in first if r[0] > 4] and read(1) == first
    assert sinks.clean_snapshot(spark, target) == []
    assert len(sinks.clean_snapshot(spark, target, keep=1, older_than=0)) == 3
    assert read() == [r for r in first if r[0] > 4]


def test_later_commit_counts_whatever_the_clock_says(spark, tmp_path):
    meta = str(tmp_path / "meta")
    for run, day in (("a", 9), ("b", 2)):
        sinks.append_run_meta(spark, meta, run, 26, 4, dt.datetime(2026, 6, day))
    assert sinks.latest_run(sinks.run_log(spark, meta).read()).first().run_id == "b"
