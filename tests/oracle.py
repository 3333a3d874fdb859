"""Compare a Spark result with DuckDB's result for the same query."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(value):
    if value is None or isinstance(value, (str, bytes)):
        return value
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, (float, decimal.Decimal)):
        number = float(value)
        return None if math.isnan(number) else float(f"{number:.12g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


SQL_TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    result = con.sql(sql)
    names, types = result.columns, [str(t) for t in result.types]
    order = sorted(df.columns)
    if order != sorted(names):
        return [f"columns {order} != {sorted(names)}"]
    problems = []
    sql_types = dict(zip(names, types))
    for field in df.schema.fields:
        mine, other = field.dataType.simpleString(), sql_types[field.name]
        if SQL_TYPES.get(mine) != other:
            problems.append(f"{field.name}: {mine} != {other}")
    at = [names.index(c) for c in order]
    key = lambda row: tuple((v is not None, str(v)) for v in row)
    mine = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=key)
    other = sorted((tuple(plain(r[i]) for i in at) for r in result.fetchall()), key=key)
    if len(mine) != len(other):
        problems.append(f"rows {len(mine)} != {len(other)}")
    wrong = [(a, b) for a, b in zip(mine, other) if a != b]
    if wrong:
        problems.append(f"{len(wrong)} rows differ, first {order}: {wrong[0]}")
    if not mine:
        problems.append("no rows")
    return problems
