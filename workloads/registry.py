"""Registered queries and, beside each, the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from millrace.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; ``sql`` is its oracle, if SQL can say it."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            for key, value in SESSION_CONF.items():
                spark.conf.set(key, value)
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
