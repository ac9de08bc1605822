"""JDBC scans. The connection, dialect and type mapping are Spark's; here a table read gets its partitions."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession, types as T

from millrace.options import exactly_one
from millrace.plans.splits import Bounds, bounds_of, ranges_of, split_predicates


def _reader(spark: SparkSession, url: str, properties: Mapping[str, str] | None):
    return spark.read.format("jdbc").option("url", url).options(**(properties or {}))


def _asker(spark: SparkSession, url: str, properties: Mapping[str, str] | None) -> Callable[[str], list]:
    return lambda remote: _reader(spark, url, properties).option("dbtable", remote).load().collect()


def remote_table(table: str | None, query: str | None) -> str:
    """What stands after FROM at the remote side."""
    exactly_one({"table": table, "query": query}, "table", "query")
    return table if table else f"({query.rstrip().rstrip(';')}) mr_query"


def statistics_query(source: str, column: str) -> str:
    """Smallest and largest key and the number of keys, computed by the database."""
    return f"(SELECT MIN({column}) AS low, MAX({column}) AS high, COUNT({column}) AS n FROM {source}) mr_statistics"


def quantile_query(source: str, column: str, splits: int) -> str:
    """The smallest key of each of ``splits`` ranges of equal row counts, computed by the database."""
    tiles = f"SELECT {column} AS k, NTILE({splits}) OVER (ORDER BY {column}) AS t FROM {source} WHERE {column} IS NOT NULL"
    return f"(SELECT MIN(k) AS k FROM ({tiles}) mr_tiles GROUP BY t) mr_quantiles"


def remote_bounds(ask: Callable[[str], list], source: str, column: str, splits: int) -> Bounds:
    """Ranges of equal row counts; ``ask`` runs a remote query. One key for each range comes back."""
    return bounds_of([row[0] for row in ask(quantile_query(source, column, splits))])


def scan_jdbc(
    spark: SparkSession,
    url: str,
    *,
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    partition_lower_bound: Any = None,
    partition_upper_bound: Any = None,
    partition_num: int | None = None,
    fetch_size: int | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A table or a remote query. With a partition column the range is cut evenly into ``partition_num`` parallel
    reads (missing bounds are asked from the database); without one there is a single reader."""
    options = dict(properties or {})
    if fetch_size:
        options["fetchsize"] = str(fetch_size)
    source = remote_table(table, query)
    reader = _reader(spark, url, options).option("dbtable", source)
    if not partition_column:
        return reader.load()
    num = partition_num or spark.sparkContext.defaultParallelism
    whole = reader.load()
    if isinstance(whole.schema[partition_column].dataType, T.StringType):
        # Text has no even ranges: ranges of equal row counts.
        bounds = remote_bounds(_asker(spark, url, options), source, partition_column, num)
        predicates = split_predicates(partition_column, bounds)
        return spark.read.jdbc(url, source, predicates=predicates, properties=options)
    low, high = partition_lower_bound, partition_upper_bound
    if low is None or high is None:
        bounds = f"(SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi FROM {source}) mr_bounds"
        row = _reader(spark, url, options).option("dbtable", bounds).load().first()
        low, high = (row[0] if low is None else low), (row[1] if high is None else high)
        if low is None:
            return whole
    return reader.options(
        partitionColumn=partition_column,
        lowerBound=str(low),
        upperBound=str(high),
        numPartitions=str(num),
    ).load()


def scan_jdbc_auto(
    spark: SparkSession,
    url: str,
    *,
    table: str | None = None,
    query: str | None = None,
    split_column: str,
    properties: Mapping[str, str] | None = None,
    **split_options: Any,
) -> DataFrame:
    """A read cut by :func:`millrace.plans.splits.ranges_of`: one partition per planned key range. The database computes
    statistics and quantiles; only those cross the connection."""
    source = remote_table(table, query)
    ask = _asker(spark, url, properties)
    low, high, rows = ask(statistics_query(source, split_column))[0]
    bounds = ranges_of(low, high, rows, lambda n: remote_bounds(ask, source, split_column, n), **split_options)
    predicates = split_predicates(split_column, bounds)
    return spark.read.jdbc(url, source, predicates=predicates, properties=dict(properties or {}))
