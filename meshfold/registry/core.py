"""Registration of queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)``; ``sql`` states the same result for DuckDB."""
    def keep(fn):
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from meshfold.session import prepare

            return fn(prepare(spark), sf_dir)

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep
