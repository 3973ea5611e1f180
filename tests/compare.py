"""Side-by-side check of a registered query and its SQL in DuckDB."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
from collections import Counter

import duckdb

LAST = [0]  # rows of the latest comparison
DUCK = {"INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double",
        "DATE": "date", "BOOLEAN": "boolean", "HUGEINT": "hugeint", "TIMESTAMP": "timestamp"}


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{root}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(round(value, 9) + 0.0)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return repr(value)


def rows(names: list[str], data) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(canonical(r[i]) for i in order) for r in data)


def differences(spark_df, con, statement: str) -> list[str]:
    """Empty when schema, row count and values agree."""
    rel = con.sql(statement)
    want_types = {n: DUCK.get(str(t), str(t)) for n, t in zip(rel.columns, rel.types)}
    got_types = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    problems = []
    if want_types.keys() != got_types.keys():
        return [f"columns differ: only Spark {got_types.keys() - want_types.keys()}, "
                f"only SQL {want_types.keys() - got_types.keys()}"]
    problems += [f"type of {n}: Spark {got_types[n]}, SQL {want_types[n]}"
                 for n in got_types if got_types[n] != want_types[n]]
    got = rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    want = rows(rel.columns, rel.fetchall())
    LAST[0] = sum(got.values())
    if got != want:
        problems.append(f"{sum(got.values())} rows against {sum(want.values())}; "
                        f"only Spark: {list((got - want).items())[:3]}; "
                        f"only SQL: {list((want - got).items())[:3]}; columns {sorted(got_types)}")
    return problems
