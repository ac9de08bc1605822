"""File scans: columnar, delimited, JSON, XML and binary files, partition and file selection.

Column and predicate push-down, partition pruning and file splitting are Spark's; these functions only map options.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.envelope import quoted, require_columns
from millrace.options import require, single_choice
from millrace.schema import schema_from_fields, spark_type

FORMATS = ("parquet", "orc", "csv", "text", "json", "xml", "binary")

# The default formats of dates, date-times and times in text files, and the default field separator.
DATE_FORMAT = "yyyy-MM-dd"
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIME_FORMAT = "HH:mm:ss"
TEXT_DELIMITER = "\x01"

Schema = T.StructType | Mapping[str, Any]


def _schema(schema: Schema) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else schema_from_fields(schema)


def _selection(
    extension: str | None,
    modified_after: str | None,
    modified_before: str | None,
    recursive: bool,
) -> dict[str, str]:
    options = {}
    if extension:
        options["pathGlobFilter"] = f"*{extension if extension.startswith('.') else '.' + extension}"
    if modified_after:
        options["modifiedAfter"] = modified_after
    if modified_before:
        options["modifiedBefore"] = modified_before
    if recursive:
        options["recursiveFileLookup"] = "true"
    return options


def _skip_lines(df: DataFrame, count: int) -> DataFrame:
    """Drop the first ``count`` lines of every file. A file's first lines are in the split that starts at 0, and a
    task reads a split in order, so counting inside the task is enough: no shuffle, no second read. Header lines that
    go on beyond the first split are an error."""
    marked = df.select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        (F.col("_metadata.file_block_length") < F.col("_metadata.file_size")).alias("more"),
    )

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: dict[str, int] = {}
        cut: set[str] = set()
        for batch in batches:
            values, paths, starts = batch.column(0), batch.column(1), batch.column(2)
            keep = pa.array([True] * len(values))
            cut.update(pc.unique(paths.filter(pc.and_(pc.equal(starts, 0), batch.column(3)))).to_pylist())
            for path in pc.unique(paths.filter(pc.equal(starts, 0))).to_pylist():
                first = pc.and_(pc.equal(paths, path), pc.equal(starts, 0))
                todo = left.get(path, count)
                if todo:
                    nth = pc.cumulative_sum(pc.cast(first, pa.int64()))
                    keep = pc.and_(keep, pc.invert(pc.and_(first, pc.less_equal(nth, todo))))
                    left[path] = max(0, todo - pc.sum(pc.cast(first, pa.int64())).as_py())
            yield pa.RecordBatch.from_arrays([values.filter(keep)], ["value"])
        beyond = [path for path in cut if left.get(path, 0)]
        if beyond:
            raise ValueError(f"the header lines of {beyond[0]} go on beyond its first split")

    return marked.mapInArrow(drop, "value string")


# What a quoted empty value reads as at first, to tell it from a missing one.
_EMPTY = "\x01empty\x01"


def _typed_csv(lines: DataFrame, schema: T.StructType, options: Mapping[str, str]) -> DataFrame:
    ddl = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    return lines.select(F.from_csv("value", ddl, dict(options)).alias("row")).select("row.*")


def scan_file(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    fmt: str = "parquet",
    schema: Schema | None = None,
    delimiter: str | None = None,
    quote_char: str = '"',
    escape_char: str = "\\",
    skip_header_row_number: int = 0,
    row_delimiter: str = "\n",
    null_format: str | None = None,
    encoding: str = "UTF-8",
    row_tag: str | None = None,
    date_format: str = DATE_FORMAT,
    datetime_format: str = DATETIME_FORMAT,
    read_columns: Sequence[str] | None = None,
    read_partitions: Sequence[str] | None = None,
    parse_partition_from_path: bool = True,
    base_path: str | None = None,
    file_filter_pattern: str | None = None,
    extension: str | None = None,
    modified_after: str | None = None,
    modified_before: str | None = None,
    multi_line: bool = False,
    partition_types: Mapping[str, str] | None = None,
) -> DataFrame:
    """Scan files of one format. Columnar files carry their schema; the other formats need a declared one.

    ``read_partitions`` lists ``k=v[/k2=v2]`` path parts of one depth; ``file_filter_pattern`` is a regular
    expression on the file name. Both become predicates that prune files before they are opened.

    Blanks around values stay. ``multi_line`` reads quoted CSV values with line breaks; such a file is one split.
    In CSV without ``null_format`` a missing value is NULL and a quoted empty one is empty; in text both are NULL.
    ``partition_types`` declares the types of partition columns; Spark infers the others, and takes ``01`` for 1.
    """
    single_choice({"fmt": fmt}, "fmt", FORMATS)
    if fmt in ("csv", "text", "json", "xml"):
        require({"schema": schema}, "schema")
    reader = spark.read.options(
        **_selection(extension, modified_after, modified_before, not parse_partition_from_path)
    )
    if base_path:
        reader = reader.option("basePath", base_path)
    paths = [path] if isinstance(path, str) else list(path)
    dates = {"dateFormat": date_format, "timestampNTZFormat": datetime_format, "timestampFormat": datetime_format}
    if partition_types and schema is None and fmt in ("parquet", "orc"):
        schema = reader.format(fmt).load(paths).schema
    if partition_types:
        inside = [f for f in _schema(schema).fields if f.name not in partition_types]
        parts = [T.StructField(name, spark_type(kind)) for name, kind in partition_types.items()]
        schema = T.StructType([*inside, *parts])
    if fmt in ("parquet", "orc"):
        df = (reader.schema(_schema(schema)) if schema else reader).format(fmt).load(paths)
    elif fmt == "binary":
        df = reader.format("binaryFile").load(paths)
    elif fmt == "json":
        df = reader.schema(_schema(schema)).options(encoding=encoding, **dates).json(paths)
    elif fmt == "xml":
        require({"row_tag": row_tag}, "row_tag")
        df = reader.schema(_schema(schema)).options(rowTag=row_tag, charset=encoding, ignoreSurroundingSpaces="false", **dates).format("xml").load(paths)
    else:
        options = {"sep": delimiter or ("," if fmt == "csv" else TEXT_DELIMITER), **dates}
        options.update(ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
        if null_format is not None:
            options["nullValue"] = null_format
        if fmt == "csv":
            options.update(quote=quote_char, escape=escape_char)
            if null_format is None:
                options["emptyValue"] = _EMPTY
        else:
            options.update(quote="", escape="")
        plain = len(row_delimiter) == 1 and skip_header_row_number <= 1
        if plain:
            options.update(encoding=encoding, lineSep=row_delimiter, header=str(skip_header_row_number == 1).lower())
            # The header line is skipped, not matched against the declared names.
            options["multiLine"] = str(multi_line).lower()
            df = reader.schema(_schema(schema)).options(enforceSchema="true", **options).csv(paths)
        else:
            if encoding.upper().replace("-", "") != "UTF8":
                raise ValueError("several header lines or long row delimiters are read as UTF-8 only")
            lines = reader.option("lineSep", row_delimiter).text(paths)
            if skip_header_row_number:
                lines = _skip_lines(lines, skip_header_row_number)
            df = _typed_csv(lines, _schema(schema), options)
        if fmt == "csv" and null_format is None:
            texts = [f.name for f in _schema(schema).fields if isinstance(f.dataType, T.StringType)]
            df = df.withColumns({n: F.when(F.col(quoted(n)) == _EMPTY, "").otherwise(F.col(quoted(n))) for n in texts})
    if file_filter_pattern:
        df = df.where(F.col("_metadata.file_name").rlike(f"^(?:{file_filter_pattern})$"))
    if read_partitions:
        df = df.where(partition_predicate(df, read_partitions))
    if read_columns:
        require_columns(df, read_columns, "read_columns")
        df = df.select(*[F.col(quoted(name)) for name in read_columns])
    return df


def partition_predicate(df: DataFrame, read_partitions: Sequence[str]):
    """The predicate on partition columns for a list of ``k=v/k2=v2`` path parts, all of one depth."""
    parsed = [[part.split("=", 1) for part in entry.strip("/").split("/")] for entry in read_partitions]
    if any(len(pair) != 2 for entry in parsed for pair in entry):
        raise ValueError(f"partitions are written k=v[/k=v]: {list(read_partitions)}")
    if len({tuple(key for key, _ in entry) for entry in parsed}) != 1:
        raise ValueError("all partitions must have the same keys and depth")
    keep = F.lit(False)
    for entry in parsed:
        one = F.lit(True)
        for key, text in entry:
            require_columns(df, [key], "read_partitions")
            one = one & (F.col(quoted(key)) == F.lit(text).cast(df.schema[key].dataType))
        keep = keep | one
    return keep


def source_filter(df: DataFrame, expression: str) -> DataFrame:
    """A predicate evaluated at the source: Catalyst pushes it into Parquet, ORC and JDBC scans."""
    return df.where(expression)


def key_range_scan(
    df: DataFrame,
    column: str,
    start: Any = None,
    end: Any = None,
    *,
    start_inclusive: bool = True,
    end_inclusive: bool = False,
) -> DataFrame:
    """Rows in an ordered key range; an open end is ``None``."""
    key = F.col(quoted(column))
    if start is not None:
        df = df.where(key >= start if start_inclusive else key > start)
    if end is not None:
        df = df.where(key <= end if end_inclusive else key < end)
    return df

