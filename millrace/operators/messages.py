"""Change-event and plain message formats: decode from and encode to JSON, text and binary messages.

Decoders keep every input column but the message (topic, offset, key and so on) and put the payload columns and the
envelope beside them. All parsing is ``from_json`` on the JVM; a message turns into zero, one or two rows in one
generator step.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.envelope import (
    DELETE,
    EVENT_MS,
    INSERT,
    KIND,
    TABLE,
    UPDATE_AFTER,
    UPDATE_BEFORE,
    payload_columns,
    quoted,
    require_columns,
)
from millrace.functions.scalar import epoch_millis
from millrace.options import single_choice
from millrace.schema import schema_from_fields

Schema = T.StructType | Mapping[str, Any]
_TEXTS = T.MapType(T.StringType(), T.StringType())


def _schema(schema: Schema) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else schema_from_fields(schema)


def _image(kind: str, row: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), row.alias("row"))


def _decoded(
    df: DataFrame,
    value: str,
    images: Column,
    table: Column,
    event_ms: Column,
    schema: T.StructType,
    ignore_errors: bool,
    understood: Column,
    wanted: Column | None = None,
) -> DataFrame:
    """One generator over the images of each message. Messages not understood raise or vanish; those not wanted
    vanish. Both are decided inside the generator: a filter would be pushed below the parse and parse again."""
    none = F.array().cast(T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("row", schema)])))
    text = F.col(quoted(value)).cast("string")
    broken = none if ignore_errors else F.raise_error(F.concat(F.lit("cannot decode change message: "), text))
    unread = text.isNull() if wanted is None else text.isNull() | ~wanted
    rows = F.when(unread, none).when(F.coalesce(understood, F.lit(False)), images).otherwise(broken)
    kept = [name for name in df.columns if name != value and name not in schema.names]
    kept = [name for name in kept if name not in (KIND, TABLE, EVENT_MS)]
    out = df.select(
        *[F.col(quoted(name)) for name in kept], table.alias(TABLE), event_ms.alias(EVENT_MS), F.inline(rows)
    )
    return out.select(
        *[F.col(f"row.{quoted(name)}").alias(name) for name in schema.names],
        *[F.col(quoted(name)) for name in kept],
        F.col("kind").alias(KIND),
        TABLE,
        EVENT_MS,
    )


def _parsed(df: DataFrame, value: str, kind: T.StructType, payload: bool = False) -> tuple[DataFrame, Column]:
    """The message parsed once, in a column of its own."""
    require_columns(df, [value], "decode")
    if payload:
        kind = T.StructType([T.StructField("payload", kind)])
    parsed = F.from_json(F.col(quoted(value)).cast("string"), kind)
    return df.withColumn("__message", parsed), F.col("__message.payload" if payload else "__message")


def _without_message(df: DataFrame) -> DataFrame:
    return df.drop("__message")


def _full_table(database: Column, table: Column) -> Column:
    return F.concat_ws(".", database, table)


def decode_debezium(
    df: DataFrame, *, value: str = "value", schema: Schema, include_schema: bool = False, ignore_errors: bool = False
) -> DataFrame:
    """``op`` c and r insert, u is a before- and an after-image, d deletes. ``include_schema`` reads the message
    from its ``payload`` wrapper."""
    fields = _schema(schema)
    source = T.StructType().add("db", "string").add("schema", "string").add("table", "string").add("ts_ms", "long")
    texts = _texts_of(fields)
    kind = T.StructType().add("before", texts).add("after", texts).add("source", source).add("op", "string").add("ts_ms", "long")
    parsed, m = _parsed(df, value, kind, include_schema)
    op, before, after = m["op"], _now(m["before"], fields, ignore_errors), _now(m["after"], fields, ignore_errors)
    images = (
        F.when(op.isin("c", "r"), F.array(_image(INSERT, after)))
        .when(op == "u", F.array(_image(UPDATE_BEFORE, before), _image(UPDATE_AFTER, after)))
        .otherwise(F.array(_image(DELETE, before)))
    )
    understood = (
        (op.isin("c", "r") & m["after"].isNotNull())
        | ((op == "u") & m["before"].isNotNull() & m["after"].isNotNull())
        | ((op == "d") & m["before"].isNotNull())
    )
    event_ms = F.coalesce(m["source"]["ts_ms"], m["ts_ms"])
    table = _full_table(m["source"]["db"], m["source"]["table"])
    return _without_message(_decoded(parsed, value, images, table, event_ms, fields, ignore_errors, understood))


def _texts_of(fields: T.StructType) -> T.StructType:
    """The same fields, all as text; bytes stay bytes, which JSON holds as Base64."""
    kinds = [f.dataType if isinstance(f.dataType, T.BinaryType) else T.StringType() for f in fields.fields]
    return T.StructType([T.StructField(field.name, kind) for field, kind in zip(fields.fields, kinds)])


def _read_text(text: Column, kind: T.DataType, ignore_errors: bool) -> Column:
    """A text as its field's type; one that does not parse raises, or is NULL when errors are ignored."""
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.from_json(text, kind)
    if isinstance(kind, T.StringType):
        return text
    return text.try_cast(kind) if ignore_errors else text.cast(kind)


def _now(data: Column, fields: T.StructType, ignore_errors: bool) -> Column:
    """The row a change leads to, from its texts."""
    return F.struct(*[_read_text(data[f.name], f.dataType, ignore_errors).alias(f.name) for f in fields.fields])


def _before(data: Column, old: Column, fields: T.StructType, ignore_errors: bool) -> Column:
    """The before-image: ``old`` holds only the changed fields, so a key present there (even as JSON null) wins."""

    def read(field: T.StructField) -> Column:
        changed = F.coalesce(F.map_contains_key(old, F.lit(field.name)), F.lit(False))
        text = F.when(changed, F.try_element_at(old, F.lit(field.name))).otherwise(data[field.name])
        return _read_text(text, field.dataType, ignore_errors).alias(field.name)

    return F.struct(*[read(field) for field in fields.fields])


def _names_match(m: Column, database_include: str | None, table_include: str | None) -> Column:
    """Database and table names match their patterns in full; a message without names is not judged here."""
    wanted = F.lit(True)
    for name, pattern in (("database", database_include), ("table", table_include)):
        if pattern:
            wanted = wanted & F.coalesce(m[name].rlike(f"^(?:{pattern})$"), F.lit(True))
    return wanted


def decode_canal(
    df: DataFrame,
    *,
    value: str = "value",
    schema: Schema,
    database_include: str | None = None,
    table_include: str | None = None,
    ignore_errors: bool = False,
) -> DataFrame:
    """``type`` with ``data[]`` and, for updates, ``old[]`` (changed fields only). DDL records carry no rows."""
    fields = _schema(schema)
    data_type = T.ArrayType(_texts_of(fields))
    kind = (
        T.StructType()
        .add("data", data_type)
        .add("old", T.ArrayType(_TEXTS))
        .add("database", "string")
        .add("table", "string")
        .add("type", "string")
        .add("es", "long")
        .add("ts", "long")
        .add("isDdl", "boolean")
    )
    parsed, m = _parsed(df, value, kind)
    action = F.upper(m["type"])
    ddl = F.coalesce(m["isDdl"], F.lit(False))
    wanted = _names_match(m, database_include, table_include) & ~ddl
    text = F.col(quoted(value)).cast("string")
    # A message holds several rows: first one record per row, then its images in plain (compiled) expressions.
    pairs = F.arrays_zip(m["data"].alias("data"), F.coalesce(m["old"], F.array().cast(T.ArrayType(_TEXTS))).alias("old"))
    none = F.array().cast(T.ArrayType(T.StructType().add("data", data_type.elementType).add("old", _TEXTS)))
    broken = none if ignore_errors else F.raise_error(F.concat(F.lit("cannot decode change message: "), text))
    understood = action.isin("INSERT", "UPDATE", "DELETE") & m["data"].isNotNull()
    records = F.when(text.isNull() | ~wanted, none).when(F.coalesce(understood, F.lit(False)), pairs).otherwise(broken)
    kept = [F.col(quoted(name)) for name in df.columns]
    table, event_ms = _full_table(m["database"], m["table"]), F.coalesce(m["es"], m["ts"])
    exploded = parsed.select(
        *kept, action.alias("__action"), table.alias("__from"), event_ms.alias("__at"), F.explode(records).alias("__record")
    )
    data, old = F.col("__record.data"), F.col("__record.old")
    now = _now(data, fields, ignore_errors)
    images = (
        F.when(F.col("__action") == "INSERT", F.array(_image(INSERT, now)))
        .when(
            F.col("__action") == "UPDATE",
            F.array(_image(UPDATE_BEFORE, _before(data, old, fields, ignore_errors)), _image(UPDATE_AFTER, now)),
        )
        .otherwise(F.array(_image(DELETE, now)))
    )
    decoded = _decoded(exploded, value, images, F.col("__from"), F.col("__at"), fields, ignore_errors, F.lit(True))
    return decoded.drop("__action", "__from", "__at", "__record")


def decode_maxwell(
    df: DataFrame,
    *,
    value: str = "value",
    schema: Schema,
    database_include: str | None = None,
    table_include: str | None = None,
    ignore_errors: bool = False,
) -> DataFrame:
    """``type`` insert, update or delete with one ``data`` object and ``old`` (changed fields only); ``ts`` is in
    seconds."""
    fields = _schema(schema)
    kind = (
        T.StructType()
        .add("data", _texts_of(fields))
        .add("old", _TEXTS)
        .add("database", "string")
        .add("table", "string")
        .add("type", "string")
        .add("ts", "long")
    )
    parsed, m = _parsed(df, value, kind)
    action, data, old = F.lower(m["type"]), m["data"], m["old"]
    now = _now(data, fields, ignore_errors)
    images = (
        F.when(action.isin("insert", "bootstrap-insert"), F.array(_image(INSERT, now)))
        .when(
            action == "update",
            F.array(_image(UPDATE_BEFORE, _before(data, old, fields, ignore_errors)), _image(UPDATE_AFTER, now)),
        )
        .otherwise(F.array(_image(DELETE, now)))
    )
    understood = action.isin("insert", "bootstrap-insert", "update", "delete") & data.isNotNull()
    wanted = _names_match(m, database_include, table_include)
    table = _full_table(m["database"], m["table"])
    return _without_message(
        _decoded(parsed, value, images, table, m["ts"] * 1000, fields, ignore_errors, understood, wanted)
    )


def decode_ogg(
    df: DataFrame,
    *,
    value: str = "value",
    schema: Schema,
    database_include: str | None = None,
    table_include: str | None = None,
    ignore_errors: bool = False,
) -> DataFrame:
    """``op_type`` I, U, D with full ``before`` and ``after`` images; ``table`` may hold ``OWNER.TABLE``."""
    fields = _schema(schema)
    kind = (
        T.StructType()
        .add("before", _texts_of(fields))
        .add("after", _texts_of(fields))
        .add("op_type", "string")
        .add("op_ts", "string")
        .add("table", "string")
    )
    parsed, m = _parsed(df, value, kind)
    wanted = F.lit(True)
    for pattern, place in ((database_include, 1), (table_include, -1)):
        if pattern:
            part = F.substring_index(m["table"], ".", place)
            wanted = wanted & F.coalesce(part.rlike(f"^(?:{pattern})$"), F.lit(True))
    op = m["op_type"]
    before, after = _now(m["before"], fields, ignore_errors), _now(m["after"], fields, ignore_errors)
    images = (
        F.when(op == "I", F.array(_image(INSERT, after)))
        .when(op == "U", F.array(_image(UPDATE_BEFORE, before), _image(UPDATE_AFTER, after)))
        .otherwise(F.array(_image(DELETE, before)))
    )
    understood = (
        ((op == "I") & m["after"].isNotNull())
        | ((op == "U") & m["before"].isNotNull() & m["after"].isNotNull())
        | ((op == "D") & m["before"].isNotNull())
    )
    event_ms = epoch_millis(m["op_ts"].try_cast("timestamp_ntz"), zoneless=True)
    return _without_message(
        _decoded(parsed, value, images, m["table"], event_ms, fields, ignore_errors, understood, wanted)
    )


def decode_connect_json(
    df: DataFrame, *, value: str = "value", schema: Schema, ignore_errors: bool = False
) -> DataFrame:
    """Connect envelopes (``{"schema": ..., "payload": ...}``): a Debezium payload by its ``op``, any other payload
    is the row itself, an insert."""
    fields = _schema(schema)
    texts = _texts_of(fields)
    event = T.StructType().add("before", texts).add("after", texts).add("op", "string").add("ts_ms", "long")
    both = T.StructType().add("payload", "string")
    parsed, m = _parsed(df, value, both)
    change, plain = F.from_json(m["payload"], event), F.from_json(m["payload"], texts)
    op, row = change["op"], _now(plain, fields, ignore_errors)
    before, after = _now(change["before"], fields, ignore_errors), _now(change["after"], fields, ignore_errors)
    images = (
        F.when(op.isin("c", "r"), F.array(_image(INSERT, after)))
        .when(op == "u", F.array(_image(UPDATE_BEFORE, before), _image(UPDATE_AFTER, after)))
        .when(op == "d", F.array(_image(DELETE, before)))
        .otherwise(F.array(_image(INSERT, row)))
    )
    is_event = F.array_contains(F.json_object_keys(m["payload"]), "op")
    understood = F.when(is_event, op.isin("c", "r", "u", "d")).otherwise(F.json_object_keys(m["payload"]).isNotNull())
    table = F.lit(None).cast("string")
    return _without_message(_decoded(parsed, value, images, table, change["ts_ms"], fields, ignore_errors, understood))


def passthrough_debezium(df: DataFrame, *, key: str = "key", value: str = "value", topic: str = "topic") -> DataFrame:
    """Raw key and value for consumers of the original format, byte for byte."""
    require_columns(df, [key, value, topic], "passthrough_debezium")
    return df.select(F.col(quoted(topic)).alias("topic"), F.col(quoted(key)).alias("key"), F.col(quoted(value)).alias("value"))


_JSON = {"ignoreNullFields": "false"}


def encode_changelog(df: DataFrame, *, fmt: str) -> DataFrame:
    """One JSON message per row in column ``value``. An update is a delete of the before-image and an insert of the
    after-image, never one merged message."""
    single_choice({"fmt": fmt}, "fmt", ("debezium", "canal", "maxwell", "ogg"))
    require_columns(df, [KIND], "encode_changelog")
    fields = payload_columns(df)
    row = F.struct(*[F.col(quoted(name)) for name in fields])
    adds = F.col(KIND).isin(INSERT, UPDATE_AFTER)
    images = {"before": F.when(~adds, row).alias("before"), "after": F.when(adds, row).alias("after")}
    if fmt == "debezium":
        op = F.when(adds, "c").otherwise("d").alias("op")
        message = F.struct(images["before"], images["after"], op)
    elif fmt == "ogg":
        op = F.when(adds, "I").otherwise("D").alias("op_type")
        message = F.struct(images["before"], images["after"], op)
    elif fmt == "canal":
        message = F.struct(F.array(row).alias("data"), F.when(adds, "INSERT").otherwise("DELETE").alias("type"))
    else:
        message = F.struct(row.alias("data"), F.when(adds, "insert").otherwise("delete").alias("type"))
    return df.select(F.to_json(message, _JSON).alias("value"))


def _beside(df: DataFrame, value: str, parsed: Column, fields: T.StructType) -> DataFrame:
    rows = df.withColumn("__message", parsed)
    kept = [name for name in df.columns if name != value and name not in fields.names]
    row = F.col("__message")
    out = rows.select(*[row[f.name].alias(f.name) for f in fields.fields], *[F.col(quoted(name)) for name in kept])
    return out


def decode_json(df: DataFrame, *, value: str = "value", schema: Schema, ignore_errors: bool = False) -> DataFrame:
    """JSON message bytes to columns. Malformed messages raise, or give NULL columns when errors are ignored."""
    fields = _schema(schema)
    mode = {"mode": "PERMISSIVE" if ignore_errors else "FAILFAST"}
    parsed = F.from_json(F.col(quoted(value)).cast("string"), fields, mode)
    return _beside(df, value, parsed, fields)


def decode_text(
    df: DataFrame, *, value: str = "value", schema: Schema, delimiter: str = ",", ignore_errors: bool = False
) -> DataFrame:
    """Delimited message text to columns."""
    fields = _schema(schema)
    options = {"sep": delimiter, "mode": "PERMISSIVE" if ignore_errors else "FAILFAST"}
    ddl = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields.fields)
    parsed = F.from_csv(F.col(quoted(value)).cast("string"), ddl, options)
    return _beside(df, value, parsed, fields)


def to_messages(
    df: DataFrame,
    *,
    key_fields: Sequence[str] = (),
    fmt: str = "json",
    field_delimiter: str = ",",
    topic: str | Column | None = None,
) -> DataFrame:
    """Message ``key`` (JSON of the key fields, NULL when there are none) and ``value`` (JSON or delimited text) as
    bytes, ready for a topic sink; ``topic`` routes each row."""
    single_choice({"fmt": fmt}, "fmt", ("json", "text"))
    require_columns(df, key_fields, "to_messages")
    row = F.struct(*[F.col(quoted(name)) for name in payload_columns(df)])
    value = F.to_json(row, _JSON) if fmt == "json" else F.to_csv(row, {"sep": field_delimiter})
    key = F.to_json(F.struct(*[F.col(quoted(name)) for name in key_fields]), _JSON) if key_fields else F.lit(None)
    out = [key.cast("string").cast("binary").alias("key"), value.cast("binary").alias("value")]
    if topic is not None:
        out.insert(0, (F.lit(topic) if isinstance(topic, str) else topic).alias("topic"))
    return df.select(*out)


def _format_module(name: str):
    """The function module of an optional message format; its jar must be on the session's class path."""
    import importlib

    return importlib.import_module(f"pyspark.sql.{name}.functions")


def has_format(spark, fmt: str) -> bool:
    """True when the session has the jar for ``avro`` or ``protobuf`` messages."""
    single_choice({"fmt": fmt}, "fmt", ("avro", "protobuf"))
    marker = {
        "avro": "org.apache.spark.sql.avro.AvroFileFormat",
        "protobuf": "org.apache.spark.sql.protobuf.utils.ProtobufUtils",
    }[fmt]
    try:
        spark._jvm.java.lang.Thread.currentThread().getContextClassLoader().loadClass(marker)
    except Exception:
        return False
    return True


def _need_format(df: DataFrame, fmt: str) -> None:
    if not has_format(df.sparkSession, fmt):
        raise RuntimeError(f"the {fmt} package is not on the class path of this session")


def decode_avro(df: DataFrame, *, value: str = "value", avro_schema: str) -> DataFrame:
    """Avro message bytes to columns."""
    _need_format(df, "avro")
    row = _format_module("avro").from_avro(F.col(quoted(value)), avro_schema)
    return df.withColumn("__message", row).drop(value).select("*", "__message.*").drop("__message")


def encode_avro(df: DataFrame, *, avro_schema: str | None = None) -> DataFrame:
    """Rows to Avro message bytes in column ``value``."""
    _need_format(df, "avro")
    row = F.struct(*[F.col(quoted(name)) for name in payload_columns(df)])
    return df.select(_format_module("avro").to_avro(row, avro_schema or "").alias("value"))


def decode_protobuf(df: DataFrame, *, value: str = "value", message: str, descriptor: str) -> DataFrame:
    """Protobuf message bytes to columns; ``descriptor`` is the compiled descriptor file."""
    _need_format(df, "protobuf")
    row = _format_module("protobuf").from_protobuf(F.col(quoted(value)), message, descriptor)
    return df.withColumn("__message", row).drop(value).select("*", "__message.*").drop("__message")


def encode_protobuf(df: DataFrame, *, message: str, descriptor: str) -> DataFrame:
    """Rows to Protobuf message bytes in column ``value``."""
    _need_format(df, "protobuf")
    row = F.struct(*[F.col(quoted(name)) for name in payload_columns(df)])
    return df.select(_format_module("protobuf").to_protobuf(row, message, descriptor).alias("value"))
