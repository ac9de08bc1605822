"""Envelope transforms: row kinds, row metadata, declared sink types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.envelope import (
    DELAY_MS,
    EVENT_MS,
    INSERT,
    KIND,
    KIND_NAMES,
    PARTITION,
    TABLE,
    quoted,
    refuse_columns,
    require_columns,
)
from millrace.functions.scalar import epoch_millis
from millrace.options import exactly_one, single_choice


def with_kind(df: DataFrame, kind: str | Column = INSERT) -> DataFrame:
    """Mark rows with a row kind (plain tables are all inserts)."""
    return df.withColumn(KIND, F.lit(kind) if isinstance(kind, str) else kind)


def filter_row_kind(
    df: DataFrame, *, include: Sequence[str] | None = None, exclude: Sequence[str] | None = None
) -> DataFrame:
    """Keep or drop rows by kind (short or long names); exactly one of the two lists is given."""
    chosen = exactly_one({"include": include, "exclude": exclude}, "include", "exclude")
    short = {long: code for code, long in KIND_NAMES.items()}
    codes = [short.get(kind, kind) for kind in (include if chosen == "include" else exclude)]
    unknown = [code for code in codes if code not in KIND_NAMES]
    if unknown:
        raise ValueError(f"filter_row_kind: unknown row kinds {unknown}")
    listed = F.col(KIND).isin(codes)
    return df.where(listed if chosen == "include" else ~listed)


def extract_row_kind(df: DataFrame, *, field: str = "row_kind", transform_type: str = "SHORT") -> DataFrame:
    """Make the stream append-only: the kind becomes a data column and every row an insert."""
    refuse_columns(df, [field], "extract_row_kind")
    single_choice({"transform_type": transform_type}, "transform_type", ("SHORT", "FULL"))
    kind = F.col(KIND)
    if transform_type == "FULL":
        names = F.create_map(*[F.lit(text) for pair in KIND_NAMES.items() for text in pair])
        kind = names[kind]
    return df.withColumns({field: kind, KIND: F.lit(INSERT)})


def _database(table: Column) -> Column:
    parts = F.split(table, r"\.")
    return F.when(F.size(parts) > 1, F.get(parts, F.lit(0)))


# Metadata keys (case-sensitive) and where each value sits in the envelope.
_METADATA = {
    "Database": (TABLE, _database),
    "Table": (TABLE, lambda table: F.substring_index(table, ".", -1)),
    "RowKind": (KIND, lambda kind: kind),
    "EventTime": (EVENT_MS, lambda ms: ms.cast("bigint")),
    "Delay": (DELAY_MS, lambda ms: ms.cast("bigint")),
    "Partition": (PARTITION, lambda parts: F.array_join(parts, ",")),
}


def add_metadata(df: DataFrame, *, metadata_fields: Mapping[str, str]) -> DataFrame:
    """Surface envelope values as columns, ``{metadata key: output name}``; absent ones are NULL."""
    unknown = [key for key in metadata_fields if key not in _METADATA]
    if unknown:
        raise ValueError(f"add_metadata: unknown keys {unknown}; keys are {list(_METADATA)}")
    refuse_columns(df, metadata_fields.values(), "add_metadata")
    columns = {}
    for key, output in metadata_fields.items():
        source, expression = _METADATA[key]
        missing_type = "bigint" if key in ("EventTime", "Delay") else "string"
        columns[output] = expression(F.col(source)) if source in df.columns else F.lit(None).cast(missing_type)
    return df.withColumns(columns)


def event_time_and_delay(df: DataFrame, *, ts_col: str, extracted_at_ms: Column | None = None) -> DataFrame:
    """Fill event time (record time in milliseconds, when not negative) and delay (extraction minus event)."""
    require_columns(df, [ts_col], "event_time_and_delay")
    stamp = F.col(quoted(ts_col))
    kind = df.schema[ts_col].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        ms = epoch_millis(stamp, isinstance(kind, T.TimestampNTZType))
    else:
        ms = stamp.cast("bigint")
    now_ms = F.unix_millis(F.current_timestamp()) if extracted_at_ms is None else extracted_at_ms
    event = F.when(ms >= 0, ms)
    return df.withColumns({EVENT_MS: event, DELAY_MS: now_ms - event})


def define_sink_type(df: DataFrame, *, columns: Sequence[Mapping[str, str]]) -> DataFrame:
    """Attach the DDL type each listed column shall have in a created target table."""
    types = {}
    for entry in columns:
        if not entry.get("column") or not entry.get("type"):
            raise ValueError(f"define_sink_type: column and type are both needed, got {dict(entry)}")
        types[entry["column"]] = entry["type"]
    require_columns(df, types, "define_sink_type")
    return df.select(
        *[
            F.col(quoted(f.name)).alias(f.name, metadata={**f.metadata, "sinkType": types[f.name]})
            if f.name in types
            else F.col(quoted(f.name))
            for f in df.schema.fields
        ]
    )


def sink_types(df: DataFrame) -> dict[str, str]:
    """The declared sink types, by column."""
    return {f.name: f.metadata["sinkType"] for f in df.schema.fields if "sinkType" in f.metadata}
