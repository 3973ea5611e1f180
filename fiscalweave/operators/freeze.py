"""Weekly freeze: a closed fiscal week keeps what it held when it was first recorded."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL_CLOSED = 999


@dataclass(frozen=True)
class Frozen:
    """``events`` to report for the quarter, and the ``store`` to persist."""

    events: DataFrame
    store: DataFrame


def _occurs(frame: DataFrame, week: str) -> Column:
    """Is the week among those of another frame?

    The set of weeks is a single scalar value of a few integers, so no row is shuffled for it.
    """
    weeks = frame.agg(F.collect_set(F.col(week).try_cast("int")).alias("w")).scalar()
    return F.array_contains(weeks, F.col(week))


def not_in_weeks(df: DataFrame, frozen: DataFrame, week: str = "fweek") -> DataFrame:
    """Rows whose week does not occur in another frame."""
    return df.filter(~_occurs(frozen, week))


def weekly_freeze(store: DataFrame, fresh: DataFrame, fy: int, qtr: int,
                  current_week: int | None, week: str = "fweek",
                  closed_weeks: DataFrame | None = None) -> Frozen:
    """Merge fresh rows of a quarter with the locked ones.

    Closed weeks come from the store; a closed week the store lacks is taken from the fresh rows
    and locked; the open week and later ones are always fresh. ``current_week`` None means the
    quarter is over. Rows without a week drop out. Running it twice changes nothing more.

    A closed week that had no rows leaves no trace in the store, so late rows may still fill it,
    unless ``closed_weeks`` (fy, qtr, week) marks it as recorded.
    """
    cur = ALL_CLOSED if current_week is None else current_week
    columns = fresh.columns
    in_quarter = (F.col("fy") == fy) & (F.col("qtr") == qtr)
    locked = store.filter(in_quarter)
    others = store.filter(~F.coalesce(in_quarter, F.lit(False)))

    recorded = locked.select(week)
    if closed_weeks is not None:
        recorded = recorded.unionByName(closed_weeks.filter(in_quarter).select(week))
    open_or_new = (F.col(week) >= cur) | ((F.col(week) < cur) & ~_occurs(recorded, week))
    events = (locked.filter(F.col(week) < cur).select(*columns)
              .unionByName(fresh.filter(open_or_new)))
    return Frozen(events=events, store=others.select(*columns).unionByName(
        events.filter(F.col(week) < cur)))
