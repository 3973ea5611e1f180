"""Tables laid out for the joins they meet: facts by fiscal period, account tables by account."""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalweave.functions.calendar import FiscalRule
from fiscalweave.sources import sinks

PERIOD = ("fy", "qtr")

#: Rows of a bucket; and the column that tells rows without a key apart, with its number of values.
BUCKET_ROWS, SPREAD, SPREADS = 250_000, "spread_", 65_536


# -- facts by fiscal period ------------------------------------------------------------------------


def write_by_period(fact: DataFrame, target: str, rule: FiscalRule, date: str = "event_date") -> int:
    """A snapshot of a fact with its fiscal year and quarter as partitions; returns its version.

    The calendar is arithmetic, so no join is needed to know the period of a row. The rebalance
    gives even files and splits a period that holds a large share of the rows. Rows without a date
    are kept in a partition of their own.
    """
    placed = fact.withColumns({"fy": rule.year(date), "qtr": rule.quarter(date)})
    return sinks.write_snapshot(placed.hint("rebalance", *PERIOD), target, PERIOD)


def read_by_period(spark: SparkSession, target: str) -> DataFrame:
    return sinks.read_snapshot(spark, target)


def in_calendar(fact: DataFrame, calendar: DataFrame, date: str = "event_date") -> DataFrame:
    """Rows of the fact on the days of a filtered calendar (date, fy, qtr, ...), with its columns.

    Joined on the period as well as on the day. What the calendar keeps, by age, week or any other
    condition, is known before the fact is read, and only the partitions of those periods are.
    """
    days = calendar.withColumnRenamed("date", date)
    return fact.join(days, [*PERIOD, date])


# -- account tables by account ---------------------------------------------------------------------


def bucket_count(*tables: DataFrame, rows: int = BUCKET_ROWS, least: int = 8) -> int:
    """How many buckets tables that are to meet need for about ``rows`` rows a bucket in the longest.

    A bucket is sorted and joined by one task, so a fixed number of them would let the memory of a
    task grow with the tables.
    """
    return max(least, math.ceil(max(t.count() for t in tables) / rows))


def spread_missing(df: DataFrame, key: str) -> DataFrame:
    """The frame with the column ``SPREAD``: 0 where the key is known, else drawn from the row.

    Rows without a key would all lie in one bucket. Tables in buckets of (key, ``SPREAD``) are
    joined on both; a missing key has no match either way.
    """
    drawn = F.pmod(F.xxhash64(*df.columns), F.lit(SPREADS)).cast("int")
    return df.withColumn(SPREAD, F.when(F.col(key).isNull(), drawn).otherwise(0))


def write_bucketed(df: DataFrame, key: str | Sequence[str], buckets: int, name: str,
                   sort: Sequence[str] = ()) -> str:
    """A catalog table in buckets of ``key``, sorted within them; returns its name.

    Tables with as many buckets of the same key join, and are grouped by it, without a shuffle of
    either; ``bucket_count`` says how many suit their rows. The files lie in the shared folder. A
    new name is made for each write, so readers of an earlier one are not disturbed; ``drop``
    removes it. A bucket cannot be split: where one key holds a large share of the rows use
    ``joins.left_lookup``, and ``spread_missing`` where many rows have none.
    """
    keys = [key] if isinstance(key, str) else list(key)
    table = f"{name}_{uuid.uuid4().hex}"
    path = sinks.scratch_path(df.sparkSession, name)
    # One task per bucket, so a bucket is one file and stays sorted when it is read.
    (df.repartition(buckets, *keys).write.format("parquet").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys, *sort).saveAsTable(table))
    return table


def drop(spark: SparkSession, table: str) -> None:
    """Forget the table and delete its files."""
    path = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'").first().data_type
    spark.sql(f"DROP TABLE {table}")
    sinks.remove(spark, path)
