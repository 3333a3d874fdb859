"""Where queries and their SQL twins are recorded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridsight.catalog.bindings import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables``; ``sql`` is the same result for DuckDB."""

    def record(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Tables(spark, sf_dir))

        run.__name__, run.__doc__ = name, build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return build

    return record
