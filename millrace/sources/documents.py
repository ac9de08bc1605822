"""Rows out of JSON documents and keyed hashes."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.envelope import quoted, require_columns
from millrace.operators.jsonpath import render_path, parse_path
from millrace.options import exactly_one, single_choice
from millrace.schema import schema_from_fields, spark_type

_TEXTS = T.ArrayType(T.StringType())


def _elements(text: Column, path: str) -> Column:
    """The values a path with ``[*]`` steps selects, as JSON texts in document order; an element without the rest of
    the path gives NULL, so parallel paths stay in step."""
    steps = parse_path(path)
    pieces: list[list] = [[]]
    for step in steps:
        if step == "*":
            pieces.append([])
        else:
            pieces[-1].append(step)

    def members(value: Column) -> Column:
        return F.from_json(value, _TEXTS)

    def inner(values: Column, piece: list) -> Column:
        return F.transform(values, lambda x: F.get_json_object(x, render_path(piece)))

    first, rest = pieces[0], pieces[1:]
    found = F.array(F.get_json_object(text, render_path(first))) if not rest else members(F.get_json_object(text, render_path(first)))
    for i, piece in enumerate(rest):
        if piece:
            found = inner(found, piece)
        if i < len(rest) - 1:
            found = F.flatten(F.transform(found, members))
    return found


def json_document_rows(
    df: DataFrame,
    *,
    column: str,
    content_field: str | None = None,
    schema: T.StructType | Mapping[str, Any] | None = None,
    json_field: Mapping[str, str] | None = None,
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per element of a JSON document.

    ``content_field`` points to an array of objects read with ``schema``; ``json_field`` gives one path per output
    column, and the selected arrays are zipped by position (``types`` names types other than string). Other input
    columns are repeated beside the rows.
    """
    require_columns(df, [column], "json_document_rows")
    chosen = exactly_one({"content_field": content_field, "json_field": json_field}, "content_field", "json_field")
    text = F.col(quoted(column)).cast("string")
    kept = [F.col(quoted(name)) for name in df.columns if name != column]
    if chosen == "content_field":
        if schema is None:
            raise ValueError("json_document_rows: content_field needs a schema")
        fields = schema if isinstance(schema, T.StructType) else schema_from_fields(schema)
        path = content_field if content_field.endswith("*]") or not content_field.endswith(".*") else content_field[:-2] + "[*]"
        rows = F.transform(_elements(text, path), lambda x: F.from_json(x, fields))
        return df.select(*kept, F.inline(rows))
    wanted = {name: spark_type((types or {}).get(name, "string")) for name in json_field}
    zipped = F.arrays_zip(*[_elements(text, path).alias(name) for name, path in json_field.items()])
    rows = F.transform(
        zipped, lambda z: F.struct(*[z[name].cast(kind).alias(name) for name, kind in wanted.items()])
    )
    return df.select(*kept, F.inline(rows))


def hash_rows(
    df: DataFrame,
    *,
    map_col: str,
    schema: T.StructType | Mapping[str, Any],
    mode: str = "all",
) -> DataFrame:
    """A keyed hash (``map<string, JSON text>``): ``all`` makes one wide row with a column per named key, ``kv`` one
    row per entry, whose first schema field is the key."""
    require_columns(df, [map_col], "hash_rows")
    single_choice({"mode": mode}, "mode", ("all", "kv"))
    fields = (schema if isinstance(schema, T.StructType) else schema_from_fields(schema)).fields
    kept = [F.col(quoted(name)) for name in df.columns if name != map_col]

    def read(text: Column, kind: T.DataType) -> Column:
        if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
            return F.from_json(text, kind)
        return text.cast(kind)

    entries = F.col(quoted(map_col))
    if mode == "all":
        return df.select(*kept, *[read(F.try_element_at(entries, F.lit(f.name)), f.dataType).alias(f.name) for f in fields])
    head, rest = fields[0], fields[1:]
    exploded = df.select(*kept, F.explode(entries).alias("__hash_key", "__hash_value"))
    value = F.from_json("__hash_value", T.StructType(list(rest)))
    row = exploded.withColumn("__hash_row", value)
    return row.select(
        *[F.col(quoted(name)) for name in df.columns if name != map_col],
        F.col("__hash_key").cast(head.dataType).alias(head.name),
        *[F.col(f"__hash_row.{quoted(f.name)}").alias(f.name) for f in rest],
    )
