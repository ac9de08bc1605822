"""Declared schemas: type strings and column lists to Spark types, lossless alignment."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.envelope import envelope_columns, quoted

# Type names of declared schemas whose Spark DDL spelling differs.
DDL_NAMES = {
    "null": "void",
    "bytes": "binary",
    "timestamp": "timestamp_ntz",
    "timestamp_tz": "timestamp",
    "time": "string",
    "float_vector": "array<float>",
    "float16_vector": "array<float>",
    "bfloat16_vector": "array<float>",
    "binary_vector": "binary",
    "sparse_float_vector": "map<int,float>",
}
_WORD = re.compile(r"`[^`]*`|[A-Za-z_][A-Za-z0-9_]*")  # a quoted word is a field name, not a type
_ROW_FIELD = re.compile(r'"?([A-Za-z_][A-Za-z0-9_.]*)"?\s*[:=]\s*')


def spark_type(spec: str | Mapping[str, Any]) -> T.DataType:
    """One declared type. A mapping is a ROW; a string may nest, with ``{name = type}`` as an inline ROW."""
    if isinstance(spec, Mapping):
        return schema_from_fields(spec)
    ddl = _WORD.sub(lambda m: DDL_NAMES.get(m.group().lower(), m.group()), _inline_rows(spec))
    return T.DataType.fromDDL(ddl)


def _inline_rows(spec: str) -> str:
    if "{" not in spec:
        return spec
    named = _ROW_FIELD.sub(lambda m: f"{quoted(m.group(1))}:", spec)
    return named.replace("{", "struct<").replace("}", ">").replace('"', "")


def schema_from_fields(fields: Mapping[str, Any]) -> T.StructType:
    """The short spelling: ``{name: type}``."""
    return T.StructType([T.StructField(name, spark_type(spec)) for name, spec in fields.items()])


def schema_from_columns(columns: Sequence[Mapping[str, Any]]) -> T.StructType:
    """The long spelling: name, type, nullable, defaultValue, comment, columnLength, columnScale."""
    fields = []
    for column in columns:
        metadata = {
            key: column[source]
            for key, source in (
                ("comment", "comment"),
                ("length", "columnLength"),
                ("scale", "columnScale"),
                ("default", "defaultValue"),
            )
            if column.get(source) is not None
        }
        fields.append(
            T.StructField(column["name"], spark_type(column["type"]), column.get("nullable", True), metadata)
        )
    return T.StructType(fields)


def schema_from_spec(spec: Mapping[str, Any] | None) -> T.StructType:
    """Either spelling; no declaration gives the one-column text table ``content``."""
    if not spec:
        return T.StructType([T.StructField("content", T.StringType())])
    if "columns" in spec:
        return schema_from_columns(spec["columns"])
    return schema_from_fields(spec["fields"])


def widens(source: T.DataType, target: T.DataType) -> bool:
    """True when every value of ``source`` has an exact value in ``target``."""
    if source == target or isinstance(target, T.StringType) or isinstance(source, T.NullType):
        return True
    integers = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if isinstance(source, integers) and isinstance(target, integers):
        return integers.index(type(source)) <= integers.index(type(target))
    if isinstance(source, T.FloatType):
        return isinstance(target, (T.DoubleType, T.DecimalType))
    if isinstance(source, T.DoubleType):
        return isinstance(target, T.DecimalType)
    return False


def default_literal(field: T.StructField) -> Column | None:
    """The declared default as a column of the field's type."""
    if "default" not in field.metadata:
        return None
    value = field.metadata["default"]
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        text = value if isinstance(value, str) else json.dumps(value)
        return F.from_json(F.lit(text), field.dataType)
    return F.lit(str(value) if not isinstance(value, (bool, int, float, str)) else value).cast(field.dataType)


def align_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to a declared schema: lossless widenings only, absent columns and NULLs take the declared default.
    Envelope columns are carried through."""
    present = {field.name: field.dataType for field in df.schema.fields}
    out = []
    for field in schema.fields:
        default = default_literal(field)
        if field.name in present:
            if not widens(present[field.name], field.dataType):
                raise ValueError(
                    f"{field.name}: {present[field.name].simpleString()} does not widen to "
                    f"{field.dataType.simpleString()}"
                )
            value = F.col(quoted(field.name)).cast(field.dataType)
            value = value if default is None else F.coalesce(value, default)
        else:
            value = F.lit(None).cast(field.dataType) if default is None else default
        out.append(value.alias(field.name, metadata=field.metadata))
    declared = {field.name for field in schema.fields}
    return df.select(*out, *[F.col(name) for name in envelope_columns(df) if name not in declared])


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Read text columns as the declared types; a value that does not parse raises."""
    return df.select(
        *[F.col(quoted(f.name)).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema.fields]
    )
