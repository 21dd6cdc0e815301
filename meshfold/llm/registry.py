"""The queries of this folder with their SQL."""

from __future__ import annotations

import importlib

from pyspark.sql import SparkSession

from meshfold.session import prepare

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)``; ``sql`` states the same rows for DuckDB."""
    def keep(fn):
        def run(spark: SparkSession, sf_dir: str):
            return fn(prepare(spark), sf_dir)

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def load_all():
    importlib.import_module("meshfold.llm.queries")
    return QUERIES, ORACLES
