"""Explicit schemas of the shared tables and the one column check used everywhere."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {"INT": T.IntegerType(), "DATE": T.DateType(), "STRING": T.StringType(),
          "DOUBLE": T.DoubleType(), "BOOLEAN": T.BooleanType(), "TIMESTAMP": T.TimestampType()}


def _struct(spec: str) -> T.StructType:
    pairs = [field.split() for field in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# The flat event contract: one row is one countable event, so cnt is always 1.
WEEKLY_EVENTS = _struct(
    "fy INT, qtr INT, fweek INT, event_date DATE, super_channel STRING, channel STRING, "
    "region STRING, team_raw STRING, account_owner STRING, event STRING, account_id STRING, "
    "firm_id STRING, sku STRING, offer_name STRING, product STRING, cnt INT, table_type STRING")

RUN_META = _struct(
    "run_id STRING, fy INT, qtr INT, finished_at TIMESTAMP, summary_text STRING, attempt STRING, "
    "store_attempt STRING")


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The frame itself, or an error naming every missing column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required column(s) {missing}; found {df.columns}")
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to a schema by name; columns the frame lacks become typed NULLs."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])
