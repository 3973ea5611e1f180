"""Calendar tables and the position of a date in them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalweave.functions.calendar import FiscalRule, quarter_progress

MAX_DAYS = 400 * 366


def date_spine(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """One row per day of a parameter range; the range is checked, so the frame stays small."""
    days = (last - first).days + 1
    if not 0 < days <= MAX_DAYS:
        raise ValueError(f"calendar range {first}..{last} is empty or beyond {MAX_DAYS} days")
    return spark.range(days, numPartitions=1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("date"))


def date_spine_of(df: DataFrame, date: Column, until: dt.date | None = None) -> DataFrame:
    """One row per day from the first to the last date found in a table, or to ``until`` if later.

    For reports on the calendar of a table; what reads a fact anyway takes ``date_spine``.
    """
    last = F.max(date) if until is None else F.greatest(F.max(date), F.lit(until))
    return (df.agg(F.min(date).alias("lo"), last.alias("hi"))
            .filter(F.col("lo").isNotNull())
            .select(F.explode(F.sequence("lo", "hi")).alias("date")))


def fiscal_calendar(days: DataFrame, rule: FiscalRule) -> DataFrame:
    d = "date"
    return days.select("date", rule.year(d).alias("fy"), rule.quarter(d).alias("qtr"),
                       rule.week(d).alias("week"))


def date_ext(days: DataFrame, rule: FiscalRule, as_of: dt.date) -> DataFrame:
    """Calendar with quarter bounds and ages: 0 is the current period, 1 the one before it."""
    d = "date"
    return fiscal_calendar(days, rule).select(
        "*", rule.quarter_start(d).alias("qtr_start"), rule.quarter_end(d).alias("qtr_end"),
        rule.year_age(d, as_of).alias("fiscal_year_age"),
        rule.quarter_age(d, as_of).alias("fiscal_qtr_age"),
        rule.week_age(d, as_of).alias("week_age"))


def calendar_weeks(calendar: DataFrame, fy_from: int, fy_to: int) -> DataFrame:
    """One row per fiscal year, quarter and week with its bounds and days inside the quarter."""
    return (calendar.filter(F.col("fy").between(fy_from, fy_to))
            .groupBy("fy", "qtr", "week")
            .agg(F.min("date").alias("week_start_date"), F.max("date").alias("week_end_date"),
                 F.count_distinct("date").cast("int").alias("day_count_in_qtr")))


def quarter_weeks(weeks: DataFrame, fy: int, qtr: int) -> DataFrame:
    return weeks.filter((F.col("fy") == fy) & (F.col("qtr") == qtr)).orderBy("week_start_date")


def current_week(weeks: DataFrame, as_of: dt.date) -> DataFrame:
    """The week holding ``as_of``, else the latest one started; no row before the calendar."""
    today = F.lit(as_of)
    rank = F.struct(F.col("week_end_date") >= today, F.col("week_start_date"))
    return (weeks.filter(F.col("week_start_date") <= today)
            .agg(F.max_by(F.struct("fy", "qtr", "week"), rank).alias("p"))
            .filter(F.col("p").isNotNull()).select("p.*"))


def progress(ext: DataFrame, as_of: dt.date) -> DataFrame:
    """Weeks completed and remaining in the quarter of ``as_of``."""
    done, left = quarter_progress(F.col("qtr_start"), F.col("qtr_end"), F.lit(as_of))
    return ext.filter(F.col("date") == F.lit(as_of)).select(
        "fy", "qtr", "week", done.alias("weeks_completed"), left.alias("weeks_remaining"))
