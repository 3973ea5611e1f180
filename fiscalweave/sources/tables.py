"""Reading warehouse tables and header-row text sheets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalweave.schemas import require_columns


def read_table(spark: SparkSession, root: str | None, name: str,
               schema: T.StructType | None = None) -> DataFrame:
    """A parquet table under ``root``, or a catalog table when there is no root."""
    if root is None:
        return spark.table(name)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{root}/{name}.parquet")


def sheet_as_table(sheet: DataFrame, required: Sequence[str], key: str) -> DataFrame:
    """Header-named text rows: required columns present, blank-key rows skipped, gaps as ''."""
    require_columns(sheet, [*required, key])
    filled = sheet.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                            for c in sheet.columns])
    return filled.filter(F.length(F.trim(F.col(key))) > 0)


def read_sheet(spark: SparkSession, path: str, required: Sequence[str], key: str) -> DataFrame:
    """A CSV export of a sheet. Columns are found by header name; short rows are padded."""
    sheet = spark.read.csv(path, header=True, inferSchema=False, mode="PERMISSIVE",
                           enforceSchema=False)
    return sheet_as_table(sheet, required, key)
