"""Actual-versus-forecast state of the week grid.

A grid row is one cell: section, label, fiscal week, value, and whether it shows an actual or a
forecast. Manual rows are typed by hand and never touched.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fiscalweave.functions.text import (day_count_label, names_other_period, next_quarter,
                                        period_label, period_rank, relabel_period, week_header,
                                        week_number)
from fiscalweave.operators.calendar import current_week

ACTUAL, FORECAST = "actual", "forecast"
# Stand-ins for "every week" and "no week"; a fiscal year has 54 weeks at most.
ALL_WEEKS, NO_WEEK = 9999, -1


def week_cap(quarters: DataFrame, weeks: DataFrame, as_of: dt.date, override: int | None = None
             ) -> DataFrame:
    """Highest week to show as actual, per (fy, qtr), and whether that is known for certain.

    Past quarters are open-ended, future ones closed, the current one ends at its current week. An
    override holds everywhere. Without a calendar position every week counts, unreliably.
    """
    periods = quarters.select("fy", "qtr").distinct()
    if override is not None:
        return periods.select("fy", "qtr", F.lit(override).alias("cap"),
                              F.lit(True).alias("reliable"))
    # The position is one scalar value taken from the calendar.
    now = current_week(weeks, as_of).select(F.struct("fy", "qtr", "week").alias("p")).scalar()
    placed = periods.withColumn("now", now)
    gap = (period_rank(F.col("now.fy"), F.col("now.qtr"))
           - period_rank(F.col("fy"), F.col("qtr")))
    cap = (F.when(F.col("now").isNull() | (gap > 0), ALL_WEEKS).when(gap < 0, NO_WEEK)
           .otherwise(F.col("now.week")))
    return placed.select("fy", "qtr", cap.cast("int").alias("cap"),
                         F.col("now").isNotNull().alias("reliable"))


def _with_cap(grid: DataFrame, caps: DataFrame) -> DataFrame:
    # `caps` has one row per fiscal quarter; a quarter without one is open-ended and unreliable.
    return (grid.join(caps, ["fy", "qtr"], "left")
            .withColumn("cap", F.coalesce("cap", F.lit(ALL_WEEKS)))
            .withColumn("reliable", F.coalesce("reliable", F.lit(False))))


def actual_or_forecast(grid: DataFrame, counts: DataFrame, caps: DataFrame,
                       write_zero_types: Sequence[str] = ()) -> DataFrame:
    """Fill each cell with its count or keep its forecast.

    Manual cells and cells without a week stay as they are. Beyond the cap a cell is a forecast.
    At or before it, a forecast cell whose count is 0 stays a forecast, unless its type writes
    zeros and the cap is reliable; any other cell becomes the actual. ``changed`` marks forecasts
    turned actual by this run, ``resolved`` is false where a cell is still a forecast. The teams of
    ``counts`` are those of the grid's labels; see ``counts.relabel_teams`` where they differ.
    """
    n = counts.select("fy", "qtr", F.col("fweek").alias("week"), F.col("team").alias("label"),
                      "table_type", F.col("n").alias("actual_n"))
    cells = _with_cap(grid.join(n, ["fy", "qtr", "week", "label", "table_type"], "left"), caps)
    count = F.coalesce("actual_n", F.lit(0).cast("long"))
    untouched = F.col("is_manual") | F.col("week").isNull()
    future = F.col("week") > F.col("cap")
    writes_zero = F.col("table_type").isin(list(write_zero_types)) & F.col("reliable")
    waits = (F.col("state") == FORECAST) & (count == 0) & ~writes_zero
    keep = untouched | future | waits
    return cells.select(
        "section", "table_type", "label", "fy", "qtr", "week",
        F.when(keep, F.col("value")).otherwise(count.cast("double")).alias("value"),
        F.when(untouched | (waits & ~future), F.col("state")).when(future, FORECAST)
        .otherwise(ACTUAL).alias("state"),
        "is_manual",
        (~keep & (F.col("state") == FORECAST)).alias("changed"),
        (untouched | ~(future | waits)).alias("resolved"))


def resolve_state_only(grid: DataFrame, caps: DataFrame) -> DataFrame:
    """State of externally computed rows: a forecast with a non-zero value becomes an actual.

    Values are never written; beyond the cap a cell is forced back to forecast.
    """
    cells = _with_cap(grid, caps)
    future = F.coalesce(F.col("week") > F.col("cap"), F.lit(False)) & ~F.col("is_manual")
    was_forecast = (F.col("state") == FORECAST) & ~F.col("is_manual") & ~future
    filled = F.coalesce(F.col("value") != 0, F.lit(False))
    return cells.select(
        *grid.columns[:grid.columns.index("state")],
        F.when(future, FORECAST).when(was_forecast & filled, ACTUAL)
        .otherwise(F.col("state")).alias("state"),
        "is_manual", (was_forecast & filled).alias("changed"),
        (~(future | (was_forecast & ~filled))).alias("resolved"))


def completed_week_flags(resolved: DataFrame) -> DataFrame:
    """Per week: is every cell of every managed row resolved?"""
    return (resolved.filter(F.col("week").isNotNull()).groupBy("fy", "qtr", "week")
            .agg(F.bool_and("resolved").alias("complete")))


def transition_audit(resolved: DataFrame) -> DataFrame:
    """Cells still forecast, and cells turned actual in this run."""
    status = F.when(F.col("changed"), "flipped").when(~F.col("resolved"), "still_forecast")
    return (resolved.withColumn("status", status).filter(F.col("status").isNotNull())
            .select("status", "section", "table_type", "label", "fy", "qtr", "week", "value"))


def close_through_cap(grid: DataFrame, caps: DataFrame) -> DataFrame:
    """Every forecast at or before a reliable cap becomes actual; manual rows never do."""
    cells = _with_cap(grid, caps)
    close = ((F.col("week") <= F.col("cap")) & F.col("reliable") & ~F.col("is_manual")
             & (F.col("state") == FORECAST))
    close = F.coalesce(close, F.lit(False))
    return cells.select(*[F.when(close, ACTUAL).otherwise(F.col("state")).alias("state")
                          if c == "state" else F.col(c) for c in grid.columns],
                        close.alias("closed_now"))


def quarter_rollover(grid: DataFrame, weeks: DataFrame, fy: int, qtr: int, max_weeks: int = 14,
                     period_words: Sequence[str] = ()) -> DataFrame:
    """The grid of the quarter after (fy, qtr).

    Rows are carried over by week position; managed cells restart as forecasts, manual ones keep
    their state, labels naming the old period are renamed and labels naming another one flagged
    (see ``text.names_other_period`` for ``period_words``).
    Fails when the calendar lacks the next quarter or it does not fit the grid.
    """
    next_fy, next_qtr = (fy, qtr + 1) if qtr < 4 else (fy + 1, 1)
    in_next = (F.col("fy") == next_fy) & (F.col("qtr") == next_qtr)
    ahead = weeks.filter(in_next)
    n = ahead.limit(max_weeks + 1).count()
    if not 0 < n <= max_weeks:
        raise ValueError(f"FY{next_fy} Q{next_qtr} has {n} weeks; expected 1 to {max_weeks}")

    def positioned(df: DataFrame, *by: str) -> DataFrame:
        return df.withColumn("pos", F.row_number().over(W.partitionBy(*by).orderBy("week")))

    row = ["section", "table_type", "label", "is_manual"]
    source = positioned(grid.filter((F.col("fy") == fy) & (F.col("qtr") == qtr)
                                    & F.col("week").isNotNull()), *row)
    old_fy, old_qtr = F.col("fy"), F.col("qtr")
    rows = source.select(*row, "fy", "qtr").distinct()
    new_fy, new_qtr = next_quarter(old_fy, old_qtr)
    rows = rows.select(
        *row, period_label(old_fy, old_qtr).alias("old_tag"),
        period_label(new_fy, new_qtr).alias("new_tag"),
        new_fy.cast("int").alias("fy"), new_qtr.cast("int").alias("qtr"))
    target = rows.join(positioned(ahead, "fy", "qtr"), ["fy", "qtr"])
    carried = source.select(*row, "pos", "value", "state")
    days = F.col("day_count_in_qtr")
    return target.join(carried, [*row, "pos"], "left").select(
        "section", "table_type",
        relabel_period(F.col("label"), F.col("old_tag"), F.col("new_tag")).alias("label"),
        "fy", "qtr", "week", "value",
        F.when(F.col("is_manual"), F.coalesce("state", F.lit(FORECAST))).otherwise(FORECAST)
        .alias("state"),
        "is_manual",
        week_header(F.col("week"), F.col("week_start_date"), F.col("week_end_date"), days)
        .alias("week_header"),
        day_count_label(days).alias("day_label"),
        names_other_period(F.col("label"), F.col("old_tag"), period_words)
        .alias("needs_review"))


def fill_week_gap(headers: DataFrame, sheet: Sequence[str] = ("sheet",),
                  first_week: int | None = None) -> DataFrame:
    """Week number per header position; a single blank between n and n+2 becomes n+1.

    Other blanks stay NULL. A sheet without any week label is numbered from ``first_week``.
    """
    by = W.partitionBy(*sheet)
    w = by.orderBy("pos")
    numbered = (headers.withColumn("parsed", week_number(F.col("label")))
                .withColumn("before", F.lag("parsed").over(w))
                .withColumn("after", F.lead("parsed").over(w)))
    filled = F.when(F.col("parsed").isNull() & (F.col("after") - F.col("before") == 2),
                    F.col("before") + 1).otherwise(F.col("parsed"))
    if first_week is not None:
        none_found = F.count("parsed").over(by) == 0
        filled = F.when(none_found, F.lit(first_week) + F.row_number().over(w) - 1
                        ).otherwise(filled)
    return numbered.select(*sheet, "pos", "label", filled.cast("int").alias("week"))
