"""JSON path extraction with per-column and per-row error handling."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.envelope import quoted, refuse_columns, require_columns
from millrace.options import single_choice
from millrace.schema import spark_type

_STEP = re.compile(r"\.([A-Za-z_][\w-]*|\*)|\['([^']+)'\]|\[(\d+|\*)\]")


def parse_path(path: str) -> list[str | int]:
    """Steps of a JSON path; forms Spark would silently answer with NULL are refused."""
    if not path.startswith("$"):
        raise ValueError(f"a JSON path starts with $: {path!r}")
    steps: list[str | int] = []
    at = 1
    while at < len(path):
        match = _STEP.match(path, at)
        if match is None:
            raise ValueError(f"unsupported JSON path {path!r} near {path[at:]!r}")
        name = match.group(1) or match.group(2)
        index = match.group(3)
        steps.append(name if name is not None else ("*" if index == "*" else int(index)))
        at = match.end()
    return steps


def render_path(steps: Sequence[str | int]) -> str:
    """The steps as a path Spark reads."""
    out = "$"
    for step in steps:
        if step == "*":
            out += "[*]"
        else:
            out += f"[{step}]" if isinstance(step, int) else f"['{step}']"
    return out


def _selected(text: Column, steps: Sequence[str | int]) -> Column:
    """What a path with ``[*]`` selects, as a JSON array for none, one or many matches; NULL where what the first
    ``[*]`` goes over is not there. Spark gives a single match without its brackets, but not where the same path runs
    over two copies of the document: there each copy has an array of its own."""
    first = list(steps).index("*")
    over = F.get_json_object(text, render_path(steps[:first]))
    twice = F.get_json_object(F.concat(F.lit("["), text, F.lit(","), text, F.lit("]")), "$[*]" + render_path(steps)[1:])
    one = F.substring(twice, F.lit(2), ((F.char_length(twice) - 3) / 2).cast("int"))
    return F.when(over.isNotNull(), F.coalesce(one, F.lit("[]")))


def _extract(text: Column, steps: Sequence[str | int]) -> tuple[Column, Column]:
    """The value as text, and whether the path exists (looked at only where the value is NULL)."""
    if "*" in steps:
        return _selected(text, steps), F.get_json_object(text, "$").isNotNull()
    value = F.get_json_object(text, render_path(steps))
    if not steps:
        return value, value.isNotNull()
    parent, leaf = F.get_json_object(text, render_path(steps[:-1])), steps[-1]
    if isinstance(leaf, int):
        there = F.json_array_length(parent) > leaf
    else:
        there = F.array_contains(F.json_object_keys(parent), leaf)
    return value, F.coalesce(there, F.lit(False))


def _source_value(df: DataFrame, field: str, path: str) -> tuple[Column, Column, T.DataType | None]:
    """(value, path exists, type when the value is not JSON text). A ROW is a positional array."""
    source, steps = F.col(quoted(field)), parse_path(path)
    kind = df.schema[field].dataType
    if isinstance(kind, T.StructType):
        if not steps or not isinstance(steps[0], int) or steps[0] >= len(kind.fields):
            raise ValueError(f"a ROW field is read by position $[0]..$[{len(kind.fields) - 1}], got {path!r}")
        inner = kind.fields[steps[0]]
        member = source.getField(inner.name)
        if len(steps) == 1:
            return member, F.lit(True), inner.dataType
        text = member if isinstance(inner.dataType, T.StringType) else F.to_json(member)
        return *_extract(text, steps[1:]), None
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return *_extract(F.to_json(source, {"ignoreNullFields": "false"}), steps), None
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return *_extract(source.cast("string"), steps), None
    raise ValueError(f"JSON path reads text, bytes, arrays, maps and rows, not {kind.simpleString()}")


def _typed(value: Column, target: T.DataType, native: T.DataType | None) -> Column:
    if native is not None:
        return value if native == target else value.try_cast(target)
    if isinstance(target, (T.ArrayType, T.MapType, T.StructType)):
        return F.from_json(value, target, {"mode": "PERMISSIVE"})
    return value if isinstance(target, T.StringType) else value.try_cast(target)


def _flat(columns: Sequence[Mapping]) -> list[dict]:
    """One entry per output column; ``path``, ``dest_field`` and ``dest_type`` may be parallel lists."""
    out = []
    for column in columns:
        paths = column["path"]
        if isinstance(paths, str):
            out.append({"dest_type": "string", **column})
            continue
        if not (len(paths) == len(column["dest_field"]) == len(column.get("dest_type", ()))):
            raise ValueError("json_path: path, dest_field and dest_type lists must have one length")
        for path, dest, kind in zip(paths, column["dest_field"], column["dest_type"]):
            out.append({**column, "path": path, "dest_field": dest, "dest_type": kind})
    return out


def json_path(df: DataFrame, *, columns: Sequence[Mapping], row_error_handle_way: str = "FAIL") -> DataFrame:
    """Append columns read by JSON path.

    An error is malformed JSON, an absent path, or a value that is not of the declared type; a JSON null and a
    NULL source are plain NULLs. Per column FAIL raises, SKIP leaves NULL, SKIP_ROW drops the row; the row-level
    way (FAIL or SKIP) applies where the column says nothing.
    """
    single_choice({"way": row_error_handle_way}, "way", ("FAIL", "SKIP"))
    entries = _flat(columns)
    require_columns(df, [entry["src_field"] for entry in entries], "json_path")
    refuse_columns(df, [entry["dest_field"] for entry in entries], "json_path")
    sources = [_source_value(df, entry["src_field"], entry["path"]) for entry in entries]
    # The extracted texts are columns of their own first, so each path is evaluated once per row however often the
    # checks below look at it.
    values = {f"__path_{i}": value for i, (value, _, _) in enumerate(sources)}
    df = df.withColumns(values)
    outputs: dict[str, Column] = {}
    keep = F.lit(True)
    for name, entry, (_, there, native) in zip(values, entries, sources):
        way = entry.get("column_error_handle_way")
        single_choice({"way": way}, "way", ("FAIL", "SKIP", "SKIP_ROW"))
        way = way or {"FAIL": "FAIL", "SKIP": "SKIP_ROW"}[row_error_handle_way]
        field, dest, value = entry["src_field"], entry["dest_field"], F.col(name)
        typed = _typed(value, spark_type(entry["dest_type"]), native)
        bad = F.when(value.isNotNull(), typed.isNull()).otherwise(F.col(quoted(field)).isNotNull() & ~there)
        if way == "FAIL":
            message = F.lit(f"json_path: {field} has no usable {entry['path']} for {dest}")
            typed = F.when(bad, F.raise_error(message)).otherwise(typed)
        elif way == "SKIP_ROW":
            keep = keep & ~bad
        outputs[dest] = typed
    # A dropped row must not raise for its other columns, so the drop comes first.
    return df.where(keep).withColumns(outputs).drop(*values)
