"""Catalog tables: one, several, or all that match a pattern."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.envelope import TablePath, TableSet, quoted
from millrace.sources.files import partition_predicate, scan_file


def scan_table(
    spark: SparkSession,
    name: str,
    *,
    read_columns: Sequence[str] | None = None,
    read_partitions: Sequence[str] | None = None,
) -> DataFrame:
    """One catalog table, with projection and partition selection at the source."""
    df = spark.table(name)
    if read_partitions:
        df = df.where(partition_predicate(df, read_partitions))
    return df.select(*[F.col(quoted(name)) for name in read_columns]) if read_columns else df


def scan_tables(spark: SparkSession, pattern: str) -> TableSet:
    """All tables whose ``database.table`` matches the regular expression in full (write the dot as ``\\.``).
    Only catalog metadata is listed; databases the pattern cannot reach are not."""
    regex = re.compile(pattern)
    found = {}
    for database in spark.catalog.listDatabases():
        for table in spark.catalog.listTables(database.name):
            if table.isTemporary:
                continue
            full = f"{database.name}.{table.name}"
            if regex.fullmatch(full):
                found[TablePath(table.name, database=database.name)] = spark.table(full)
    return TableSet(dict(sorted(found.items(), key=lambda item: str(item[0]))))


def scan_many(spark: SparkSession, tables_configs: Sequence[Mapping]) -> TableSet:
    """Several tables from one source: each entry is ``{"table_path": ..., "path": ..., other scan options}``, with an
    optional ``query`` over its rows."""
    frames = {}
    for entry in tables_configs:
        options = {key: value for key, value in entry.items() if key not in ("table_path", "path", "query")}
        df = scan_file(spark, entry["path"], **options)
        if entry.get("query"):
            from millrace.operators.sql import sql

            df = sql(df, entry["query"], table_name=TablePath.parse(entry["table_path"]).table)
        frames[TablePath.parse(entry["table_path"])] = df
    return TableSet(frames)
