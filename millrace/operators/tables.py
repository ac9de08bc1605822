"""Transforms over sets of tables: filter, rename, merge, per-table rules, sharding."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from millrace.envelope import TABLE, TablePath, TableSet
from millrace.operators.fields import renamed
from millrace.options import single_choice

Transform = Callable[[DataFrame], DataFrame]


def filter_tables(
    tables: TableSet,
    *,
    database_pattern: str | None = None,
    schema_pattern: str | None = None,
    table_pattern: str | None = None,
    pattern_mode: str = "INCLUDE",
) -> TableSet:
    """Keep (or drop) the tables whose parts all match their pattern in full; no pattern matches anything."""
    single_choice({"pattern_mode": pattern_mode}, "pattern_mode", ("INCLUDE", "EXCLUDE"))

    def part(pattern: str | None, value: str | None) -> bool:
        return pattern is None or (value is not None and re.fullmatch(pattern, value) is not None)

    def matches(path: TablePath) -> bool:
        return (
            part(database_pattern, path.database)
            and part(schema_pattern, path.schema)
            and part(table_pattern, path.table)
        )

    return tables.keep(lambda path: matches(path) == (pattern_mode == "INCLUDE"))


def rename_table(
    tables: TableSet,
    *,
    convert_case: str | None = None,
    prefix: str = "",
    suffix: str = "",
    replacements_with_regex: Sequence[Mapping] = (),
) -> TableSet:
    """Rename tables by rule; the replacement rules are always regular expressions."""
    rules = [{**rule, "is_regex": True} for rule in replacements_with_regex]

    def target(path: TablePath) -> TablePath:
        name = renamed(path.table, convert_case=convert_case, prefix=prefix, suffix=suffix, replacements=rules)
        return TablePath(name, path.database, path.schema)

    return tables.rekey(target)


def merge_tables(
    tables: TableSet, *, table: str, database: str | None = None, schema: str | None = None
) -> TableSet:
    """Shard tables of one schema under a single id."""
    if not tables:
        raise ValueError("merge_tables: no tables to merge")
    target = TablePath(table, database, schema)
    frames = [df.withColumn(TABLE, F.lit(str(target))) if TABLE in df.columns else df for df in tables.values()]
    first = next(iter(tables))
    return TableSet({target: reduce(DataFrame.unionByName, frames)}, {target: tables.meta(first)})


def for_tables(
    tables: TableSet,
    transform: Transform | None = None,
    *,
    table_match_regex: str = ".*",
    table_transform: Mapping[str, Transform] | None = None,
) -> TableSet:
    """Apply a transform per table: a rule for the exact path beats the regex rule, the rest pass unchanged."""
    own = {TablePath.parse(name): fn for name, fn in (table_transform or {}).items()}
    unknown = [str(path) for path in own if path not in tables.frames]
    if unknown:
        raise ValueError(f"for_tables: rules for tables that are not there: {unknown}")

    def apply(path: TablePath, df: DataFrame) -> DataFrame:
        if path in own:
            return own[path](df)
        if transform is not None and re.fullmatch(table_match_regex, str(path)):
            return transform(df)
        return df

    return tables.map(apply)


def shard_mode(tables: TableSet, *, mode: str, table: str | None = None) -> TableSet:
    """How source tables reach the sink: SINGLENESS takes one table alone, SHARDING merges like shards into one
    table, MULTIPLEX keeps many tables side by side."""
    single_choice({"mode": mode}, "mode", ("SINGLENESS", "SHARDING", "MULTIPLEX"))
    if mode == "SINGLENESS" and len(tables) != 1:
        raise ValueError(f"shard_mode SINGLENESS takes one table, got {len(tables)}")
    if mode == "SHARDING":
        return merge_tables(tables, table=table or next(iter(tables)).table)
    return tables


def flatten_tables(tables: TableSet) -> DataFrame:
    """All rows of like tables in one DataFrame, labelled with their table path."""
    return reduce(
        DataFrame.unionByName, [df.withColumn(TABLE, F.lit(str(path))) for path, df in tables.items()]
    )
