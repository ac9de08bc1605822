"""Generated rows and literal rows.

Values are hashes of (seed, row id, field), not random draws: the same rows come out under any partitioning and after
any task retry.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.envelope import KIND, KIND_NAMES, SEQ, quoted
from millrace.schema import default_literal, schema_from_fields, schema_from_spec

# Default sizes and ranges of generated values.
DEFAULTS = {
    "string.length": 5,
    "array.size": 5,
    "map.size": 5,
    "bytes.length": 5,
    "vector.dimension": 4,
    "binary.vector.dimension": 8,
    "tinyint.min": 0,
    "tinyint.max": 127,
    "smallint.min": 0,
    "smallint.max": 32767,
    "int.min": 0,
    "int.max": 2147483647,
    "bigint.min": 0,
    "bigint.max": 9007199254740991,
    "float.min": 0.0,
    "float.max": 1.0,
    "double.min": 0.0,
    "double.max": 1.0,
    "date.start": "2000-01-01",
    "date.days": 8000,
}
_TYPE_KEYS = {
    T.ByteType: "tinyint",
    T.ShortType: "smallint",
    T.IntegerType: "int",
    T.LongType: "bigint",
    T.FloatType: "float",
    T.DoubleType: "double",
    T.StringType: "string",
    T.BooleanType: "boolean",
    T.DateType: "date",
    T.TimestampNTZType: "timestamp",
    T.TimestampType: "timestamp_tz",
    T.BinaryType: "bytes",
}


def _unit(h: Column) -> Column:
    """A hash as a number in [0, 1)."""
    return F.pmod(h, F.lit(1 << 53)).cast("double") / float(1 << 53)


def _value(kind: T.DataType, salt: Sequence[Column], options: Mapping[str, Any]) -> Column:
    h = F.xxhash64(*salt)
    key = _TYPE_KEYS.get(type(kind), "decimal" if isinstance(kind, T.DecimalType) else None)
    pool = options.get(f"{key}.template")
    if pool:
        values = F.array(*[F.lit(v).cast(kind) for v in pool])
        return F.get(values, F.pmod(h, F.lit(len(pool))).cast("int"))
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        low, high = int(options[f"{key}.min"]), int(options[f"{key}.max"])
        return (F.lit(low) + F.pmod(h, F.lit(high - low + 1))).cast(kind)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        low, high = float(options[f"{key}.min"]), float(options[f"{key}.max"])
        return (F.lit(low) + _unit(h) * (high - low)).cast(kind)
    if isinstance(kind, T.DecimalType):
        # A hash gives 15 digits; a wider number is put together from several.
        blocks = [F.pmod(F.xxhash64(*salt, F.lit(i)) if i else h, F.lit(10**15)) for i in range(-(-kind.precision // 15))]
        digits = F.right(F.concat(*[F.lpad(b.cast("string"), 15, "0") for b in blocks]), F.lit(kind.precision))
        whole = F.left(digits, F.lit(kind.precision - kind.scale))
        return F.concat(F.lit("0"), whole, F.lit("."), F.right(digits, F.lit(kind.scale)), F.lit("0")).cast(T.DecimalType(38, kind.scale)).cast(kind)
    if isinstance(kind, T.BooleanType):
        return F.pmod(h, F.lit(2)) == 1
    if isinstance(kind, T.StringType):
        length = int(options["string.length"])
        blocks = [F.sha2(F.concat_ws(":", *[s.cast("string") for s in salt], F.lit(i)), 256) for i in range(-(-length // 64))]
        # Hex digits become letters a to p.
        return F.left(F.translate(F.concat(*blocks), "0123456789abcdef", "abcdefghijklmnop"), F.lit(length))
    if isinstance(kind, T.BinaryType):
        length = int(options["bytes.length"])
        blocks = [h.cast("string") if i == 0 else F.concat_ws(":", h.cast("string"), F.lit(i)) for i in range(-(-length // 64))]
        return F.unhex(F.left(F.concat(*[F.sha2(b, 512) for b in blocks]), F.lit(2 * length)))
    day = F.date_add(F.lit(options["date.start"]).cast("date"), F.pmod(h, F.lit(int(options["date.days"]))).cast("int"))
    if isinstance(kind, T.DateType):
        return day
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        seconds = F.pmod(F.xxhash64(*salt, F.lit("seconds")), F.lit(86400))
        return F.timestamp_add("SECOND", seconds, day.cast("timestamp_ntz")).cast(kind)
    if isinstance(kind, T.ArrayType):
        return _sequence(kind.elementType, salt, options, int(options["array.size"]))
    if isinstance(kind, T.MapType):
        size = int(options["map.size"])
        if isinstance(kind.keyType, T.StringType):
            keys = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.concat(F.lit("key_"), i.cast("string")))
        else:
            keys = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: i.cast(kind.keyType))
        return F.map_from_arrays(keys, _sequence(kind.valueType, salt, options, size))
    if isinstance(kind, T.StructType):
        return F.struct(
            *[_value(f.dataType, [*salt, F.lit(f.name)], options).alias(f.name) for f in kind.fields]
        )
    return F.lit(None).cast(kind)


def _sequence(kind: T.DataType, salt: Sequence[Column], options: Mapping[str, Any], size: int) -> Column:
    if size <= 0:
        return F.array().cast(T.ArrayType(kind))
    return F.array(*[_value(kind, [*salt, F.lit(i)], options) for i in range(size)])


def generate_columns(
    df: DataFrame,
    *,
    id_col: str,
    schema: T.StructType | Mapping[str, Any],
    seed: int = 0,
    auto_increment: Mapping[str, int] | None = None,
    **options: Any,
) -> DataFrame:
    """Generated columns for rows that have a unique id. Options are written with ``__`` for the dot:
    ``int__min=0``, ``string__template=[...]``, ``array__size=3``."""
    fields = schema if isinstance(schema, T.StructType) else (
        schema_from_spec(schema) if "fields" in schema or "columns" in schema else schema_from_fields(schema)
    )
    settings = {**DEFAULTS, **{key.replace("__", "."): value for key, value in options.items()}}
    row_id = F.col(quoted(id_col))
    out = []
    for field in fields.fields:
        default = default_literal(field)
        if field.name in (auto_increment or {}):
            value = (row_id + F.lit(auto_increment[field.name])).cast(field.dataType)
        elif default is not None:
            value = default
        elif isinstance(field.dataType, T.ArrayType) and f"{field.name}.size" in settings:
            value = _sequence(
                field.dataType.elementType, [F.lit(seed), row_id, F.lit(field.name)], settings, settings[f"{field.name}.size"]
            )
        else:
            value = _value(field.dataType, [F.lit(seed), row_id, F.lit(field.name)], settings)
        out.append(value.alias(field.name, metadata=field.metadata))
    return df.select(*out)


def generate(
    spark: SparkSession,
    *,
    schema: T.StructType | Mapping[str, Any],
    row_num: int,
    parallelism: int | None = None,
    seed: int = 0,
    auto_increment: Mapping[str, int] | None = None,
    **options: Any,
) -> DataFrame:
    """``row_num`` rows in all (not per reader). ``auto_increment={"id": 100}`` makes a column count up from 100,
    unique across partitions because it comes from the global row id."""
    ids = spark.range(0, row_num, 1, parallelism) if parallelism else spark.range(row_num)
    return generate_columns(ids, id_col="id", schema=schema, seed=seed, auto_increment=auto_increment, **options)


# The texts that stand for the time of the run in literal rows.
_NOW = {
    "CURRENT_TIMESTAMP": lambda: F.current_timestamp().cast("timestamp_ntz"),
    "CURRENT_DATE": F.current_date,
    "CURRENT_TIME": lambda: F.date_format(F.current_timestamp(), "HH:mm:ss"),
}


def literal_rows(
    spark: SparkSession, *, schema: T.StructType | Mapping[str, Any], rows: Sequence[tuple[str, Sequence[Any]]]
) -> DataFrame:
    """Rows written out in a job, each ``(kind, values)``; their order becomes ``__seq``. Values are read as their
    field's type; CURRENT_TIMESTAMP, CURRENT_DATE and CURRENT_TIME stand for the run's time."""
    fields = (schema if isinstance(schema, T.StructType) else schema_from_fields(schema)).fields
    texts = []
    for i, (kind, values) in enumerate(rows):
        if len(values) != len(fields):
            raise ValueError(f"row {i} has {len(values)} values for {len(fields)} fields")
        if kind not in KIND_NAMES:
            kind = {name: short for short, name in KIND_NAMES.items()}[kind]
        texts.append((kind, i, *[None if v is None else str(v) for v in values]))
    raw = T.StructType(
        [T.StructField(KIND, T.StringType()), T.StructField(SEQ, T.LongType())]
        + [T.StructField(f"__v{i}", T.StringType()) for i in range(len(fields))]
    )
    df = spark.createDataFrame(texts, raw)

    def read(i: int, field: T.StructField) -> Column:
        text = F.col(f"__v{i}")
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.from_json(text, field.dataType)
        value = text.try_cast(field.dataType)
        written = {row[i + 2] for row in texts}
        for word, now in _NOW.items():
            if word in written:
                value = F.when(text == word, now().cast(field.dataType)).otherwise(value)
        return value

    return df.select(*[read(i, f).alias(f.name) for i, f in enumerate(fields)], KIND, SEQ)
