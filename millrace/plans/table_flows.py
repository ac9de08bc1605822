"""Many tables in one job: sources that give a set of tables, transforms by table, sinks with placeholders.

A message stream of many tables is scanned once. In a batch job its messages are written by table to the scratch folder in
that one pass, and every table reads its own part under its own schema. In a streaming job one query takes all tables: each
micro-batch is read once and handed to the tables in it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.envelope import TableMeta, TablePath, TableSet, payload_columns, quoted
from millrace.operators import messages, tables as table_operators
from millrace.schema import schema_from_fields
from millrace.session import scratch_dir
from millrace.sinks.keyed import KeyedTable
from millrace.sinks.tables import resolve_name
from millrace.sources.files import scan_file
from millrace.streaming.scan import scan_stream
from millrace.streaming.sinks import stream_route_changelog

Transform = Callable[[DataFrame], DataFrame]

# Message formats: how messages of one table are decoded, and where a message names its database and table.
FORMATS: dict[str, tuple[Callable[..., DataFrame], str, str]] = {
    "debezium": (messages.decode_debezium, "$.source.db", "$.source.table"),
    "canal": (messages.decode_canal, "$.database", "$.table"),
    "maxwell": (messages.decode_maxwell, "$.database", "$.table"),
}

_TABLE = "__fan_table"


@dataclass(frozen=True)
class StreamedTables:
    """Tables of one message stream: what makes each table's rows out of its messages. ``routes`` are the names messages
    carry, ``paths`` what the tables are called by now."""

    stream: DataFrame
    table_of: Column
    steps: dict[str, Transform]
    paths: dict[str, TablePath]
    metas: dict[str, TableMeta]

    def schema(self, route: str) -> T.StructType:
        """The payload a table has after its steps, without data."""
        none = self.stream.sparkSession.createDataFrame([], self.stream.schema)
        rows = self.steps[route](none)
        return T.StructType([rows.schema[name] for name in payload_columns(rows)])


Tables = TableSet | StreamedTables


def _messages(fmt: str, schemas: Mapping[str, Mapping[str, Any]]) -> tuple[Column, dict[str, Transform]]:
    decode, database, table = FORMATS[fmt]
    value = F.col("value").cast("string")
    named = F.concat_ws(".", F.get_json_object(value, database), F.get_json_object(value, table))
    steps = {name: (lambda rows, schema=schema: decode(rows, schema=schema)) for name, schema in schemas.items()}
    return named, steps


def message_tables(
    spark: SparkSession,
    path: str,
    *,
    schemas: Mapping[str, Mapping[str, Any]],
    format: str = "debezium",
    primary_keys: Mapping[str, Sequence[str]] | None = None,
    streaming: bool = False,
    **options: Any,
) -> Tables:
    """The tables in a folder of change messages (a ``value`` column, and ``__seq`` where there is an order): ``schemas`` gives
    the fields of each by ``database.table``. Messages of other tables are left alone. As a batch they are written by table
    in one pass, here and now."""
    if format not in FORMATS:
        raise ValueError(f"unknown message format {format!r}; known are {sorted(FORMATS)}")
    named, steps = _messages(format, schemas)
    metas = {name: TableMeta(primary_key=tuple((primary_keys or {}).get(name, ()))) for name in schemas}
    if streaming:
        stream = scan_stream(spark, path, schema=schema_from_fields(options.pop("schema", {"value": "string", "__seq": "bigint"})), **options)
        return StreamedTables(stream, named, steps, {name: TablePath.parse(name) for name in schemas}, metas)
    found = scan_file(spark, path, **options).withColumn(_TABLE, named)
    folder = scratch_dir(spark, "fanned-out")
    found.where(F.col(_TABLE).isin(list(schemas))).write.partitionBy(_TABLE).parquet(folder)
    stored = spark.read.schema(found.schema).parquet(folder)
    frames = {TablePath.parse(name): step(stored.where(F.col(_TABLE) == name).drop(_TABLE)) for name, step in steps.items()}
    return TableSet(frames, {TablePath.parse(name): meta for name, meta in metas.items()})


def map_tables(tables: Tables, step_for: Callable[[TablePath], Transform | None]) -> Tables:
    """Apply to each table what ``step_for`` gives for its path, if anything."""
    if isinstance(tables, TableSet):
        return tables.map(lambda path, df: (step_for(path) or (lambda rows: rows))(df))
    steps = dict(tables.steps)
    for route, path in tables.paths.items():
        step = step_for(path)
        if step:
            steps[route] = lambda rows, first=steps[route], then=step: then(first(rows))
    return replace(tables, steps=steps)


def transform_tables(tables: Tables, make: Callable[[Mapping[str, Any]], Transform], entry: Mapping[str, Any]) -> Tables:
    """An ordinary transform over a set of tables. ``table_transform`` lists options by ``table_path``, which beat those of the
    entry itself; these hold for the tables that ``table_match_regex`` matches in full (all, where it is not given)."""
    options = dict(entry)
    own = {TablePath.parse(o["table_path"]): {k: v for k, v in o.items() if k != "table_path"} for o in options.pop("table_transform", ())}
    pattern = options.pop("table_match_regex", ".*")
    known = set(tables.paths.values() if isinstance(tables, StreamedTables) else tables)
    unknown = [str(path) for path in own if path not in known]
    if unknown:
        raise ValueError(f"rules for tables that are not there: {unknown}")

    def step_for(path: TablePath) -> Transform | None:
        if path in own:
            return make(own[path])
        return make(options) if options and re.fullmatch(pattern, str(path)) else None

    return map_tables(tables, step_for)


def _names(tables: StreamedTables) -> TableSet:
    """The paths of streamed tables as a set without rows, for what only looks at names."""
    return TableSet({path: None for path in tables.paths.values()})


def rename_tables(tables: Tables, **rules: Any) -> Tables:
    if isinstance(tables, TableSet):
        return table_operators.rename_table(tables, **rules)
    before = list(tables.paths.values())
    after = dict(zip(before, table_operators.rename_table(_names(tables), **rules)))
    return replace(tables, paths={route: after[path] for route, path in tables.paths.items()})


def filter_tables(tables: Tables, **patterns: Any) -> Tables:
    if isinstance(tables, TableSet):
        return table_operators.filter_tables(tables, **patterns)
    kept = set(table_operators.filter_tables(_names(tables), **patterns))
    routes = [route for route, path in tables.paths.items() if path in kept]
    pick = lambda of: {route: of[route] for route in routes}
    return replace(tables, steps=pick(tables.steps), paths=pick(tables.paths), metas=pick(tables.metas))


TABLE_TRANSFORMS: dict[str, Callable[..., Tables]] = {
    "TableFilter": filter_tables,
    "TableRename": rename_tables,
    "TableMerge": table_operators.merge_tables,
}


def _filled(options: Any, path: TablePath, df: DataFrame | None, meta: TableMeta) -> Any:
    """Options with the placeholders of a table filled in, at any depth."""
    if isinstance(options, str):
        return resolve_name(options, path, df, meta)
    if isinstance(options, Mapping):
        return {key: _filled(value, path, df, meta) for key, value in options.items()}
    return [_filled(value, path, df, meta) for value in options] if isinstance(options, (list, tuple)) else options


def write_tables(tables: TableSet, write: Callable[..., Any], options: Mapping[str, Any]) -> None:
    """A sink for each table, its options filled in. Without a placeholder all tables would go to one target: an error."""
    filled = {path: _filled(options, path, df, tables.meta(path)) for path, df in tables.items()}
    if len({repr(sorted(o.items(), key=lambda i: i[0])) for o in filled.values()}) < len(filled):
        raise ValueError("several tables would go to one target: use placeholders such as ${table_name}")
    for path, df in tables.items():
        write(df, **filled[path])


def start_keyed_tables(
    tables: StreamedTables, *, path: str, checkpoint: str, keys: Sequence[str] | None = None, interval_ms: int | None = None, **settings: Any
) -> StreamingQuery:
    """One query that keeps a keyed table for each table, at ``path`` with its placeholders filled in. Keys are the table's
    primary key unless given."""
    routes = {}
    for route, at in tables.paths.items():
        schema, meta = tables.schema(route), tables.metas[route]
        own = list(keys or meta.primary_key)
        if not own:
            raise ValueError(f"no keys for table {at}")
        target = _filled(path, at, None, meta)
        routes[route] = (tables.steps[route], KeyedTable(tables.stream.sparkSession, target, keys=own, schema=schema, **settings))
    if len({table.path for _, table in routes.values()}) < len(routes):
        raise ValueError("several tables would go to one target: use placeholders such as ${table_name}")
    return stream_route_changelog(tables.stream, routes, checkpoint, table_of=tables.table_of, interval_ms=interval_ms)
