"""Schema-change events applied to DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, functions as F, types as T

from millrace.envelope import TablePath, TableSet, quoted, refuse_columns, require_columns
from millrace.schema import spark_type, widens


@dataclass(frozen=True)
class AddColumn:
    name: str
    type: str
    default: Any = None
    comment: str | None = None
    first: bool = False
    after: str | None = None


@dataclass(frozen=True)
class DropColumn:
    name: str


@dataclass(frozen=True)
class ModifyColumn:
    name: str
    type: str


@dataclass(frozen=True)
class RenameColumn:
    name: str
    to: str


@dataclass(frozen=True)
class RenameTable:
    table: str
    to: str


ColumnEvent = AddColumn | DropColumn | ModifyColumn | RenameColumn


def _apply(df: DataFrame, event: ColumnEvent) -> DataFrame:
    if isinstance(event, AddColumn):
        refuse_columns(df, [event.name], "add column")
        kind = spark_type(event.type)
        metadata = {key: value for key, value in (("comment", event.comment), ("default", event.default)) if value is not None}
        value = F.lit(event.default).cast(kind).alias(event.name, metadata=metadata)
        columns = [F.col(quoted(name)) for name in df.columns]
        if event.first:
            at = 0
        elif event.after is not None:
            require_columns(df, [event.after], "add column after")
            at = df.columns.index(event.after) + 1
        else:
            at = len(columns)
        return df.select(*columns[:at], value, *columns[at:])
    require_columns(df, [event.name], type(event).__name__)
    if isinstance(event, DropColumn):
        return df.drop(event.name)
    if isinstance(event, RenameColumn):
        if event.to != event.name:
            refuse_columns(df, [event.to], "rename column")
        return df.withColumnRenamed(event.name, event.to)
    kind = spark_type(event.type)
    if not widens(df.schema[event.name].dataType, kind):
        raise ValueError(
            f"modify column {event.name}: {df.schema[event.name].dataType.simpleString()} does not widen to "
            f"{kind.simpleString()}"
        )
    return df.withColumn(event.name, F.col(quoted(event.name)).cast(kind))


def evolve_schema(df: DataFrame, events: Sequence[ColumnEvent]) -> DataFrame:
    """Apply column events in order: a chain of projections that Catalyst collapses into one. Casts that could
    lose values are refused."""
    for event in events:
        df = _apply(df, event)
    return df


def evolved_schema(schema: T.StructType, events: Sequence[ColumnEvent], spark) -> T.StructType:
    """The schema the events lead to, without data."""
    return evolve_schema(spark.createDataFrame([], schema), events).schema


def evolve_tables(tables: TableSet, events: Sequence[tuple[str, ColumnEvent] | RenameTable]) -> TableSet:
    """Apply ``(table, column event)`` pairs and table renames, in order, over a set of tables."""
    for event in events:
        if isinstance(event, RenameTable):
            source, target = TablePath.parse(event.table), TablePath.parse(event.to)
            if source not in tables.frames:
                raise ValueError(f"rename table: no table {source}")
            tables = tables.rekey(lambda path: target if path == source else path)
        else:
            name, change = event
            path = TablePath.parse(name)
            if path not in tables.frames:
                raise ValueError(f"schema change: no table {path}")
            tables = tables.map(lambda p, df: evolve_schema(df, [change]) if p == path else df)
    return tables
