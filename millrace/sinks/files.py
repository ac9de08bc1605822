"""File sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from millrace.envelope import payload_columns, quoted, require_columns
from millrace.options import single_choice
from millrace.sources.files import DATE_FORMAT, DATETIME_FORMAT, TEXT_DELIMITER

# The duplicate of a partition column that goes into the directory name when the column also stays in the file.
PARTITION_COPY = "__dir_{}"


def _writer_options(
    fmt: str,
    field_delimiter: str | None,
    row_delimiter: str,
    header: bool,
    null_format: str | None,
    date_format: str,
    datetime_format: str,
) -> dict:
    options = {}
    if fmt in ("csv", "text"):
        options["sep"] = field_delimiter or ("," if fmt == "csv" else TEXT_DELIMITER)
        options["lineSep"] = row_delimiter
        options["header"] = str(header).lower()
        options.update(ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
        if null_format is not None:
            options["nullValue"] = null_format
        if fmt == "text":
            options.update(quote="", escape="", emptyValue="")
        else:
            options["escape"] = "\\"
    if fmt in ("csv", "text", "json", "xml"):
        options.update(dateFormat=date_format, timestampNTZFormat=datetime_format, timestampFormat=datetime_format)
    return options


def _plain_texts(rows: DataFrame, directories: Sequence[str], *marks: str) -> DataFrame:
    """Text files have no quotes: a value with a delimiter in it raises."""
    checked = {}
    for field in rows.schema.fields:
        if isinstance(field.dataType, T.StringType) and field.name not in directories:
            value = F.col(quoted(field.name))
            bad = F.lit(False)
            for mark in marks:
                bad = bad | value.contains(mark)
            message = F.lit(f"write_files: a value of {field.name} holds a delimiter, which text files cannot")
            checked[field.name] = F.when(bad, F.raise_error(message)).otherwise(value)
    return rows.withColumns(checked)


def sink_rows(
    df: DataFrame,
    *,
    sink_columns: Sequence[str] | None = None,
    partition_by: Sequence[str] = (),
    is_partition_field_write_in_file: bool = False,
) -> tuple[DataFrame, list[str]]:
    """The columns a file sink writes, in order, and the columns that name its directories."""
    columns = list(sink_columns or payload_columns(df))
    require_columns(df, [*columns, *partition_by], "write_files")
    if not is_partition_field_write_in_file:
        inside = [name for name in columns if name not in partition_by]
        return df.select(*[F.col(quoted(name)) for name in [*inside, *partition_by]]), list(partition_by)
    copies = [F.col(quoted(name)).alias(PARTITION_COPY.format(name)) for name in partition_by]
    inside = [*columns, *[name for name in partition_by if name not in columns]]
    return df.select(*[F.col(quoted(n)) for n in inside], *copies), [PARTITION_COPY.format(n) for n in partition_by]


def write_files(
    df: DataFrame,
    path: str,
    *,
    fmt: str = "parquet",
    sink_columns: Sequence[str] | None = None,
    field_delimiter: str | None = None,
    row_delimiter: str = "\n",
    header: bool = False,
    null_format: str | None = None,
    row_tag: str = "row",
    root_tag: str = "rows",
    date_format: str = DATE_FORMAT,
    datetime_format: str = DATETIME_FORMAT,
    partition_by: Sequence[str] = (),
    is_partition_field_write_in_file: bool = False,
    rebalance: bool = False,
    mode: str = "error",
) -> None:
    """Write chosen columns in order. Spark's commit protocol publishes a finished job or nothing.

    ``date_format`` and ``datetime_format`` are those of ``scan_file``; the default writes whole seconds, a pattern with
    ``SSSSSS`` keeps fractions. CSV quotes values with line breaks (``multi_line`` reads them); text files cannot hold a
    delimiter, line break or carriage return inside a value, so such a row is an error.

    A partition column leaves the file unless ``is_partition_field_write_in_file``; then the directory is named by a
    copy. An empty input still writes one file with the schema (delimited files need ``header`` for that). ``rebalance`` shuffles rows towards
    their folder first, so that many tasks do not each write a small file into every folder; adaptive execution cuts a
    folder that holds much of the data into several tasks.
    """
    single_choice({"fmt": fmt}, "fmt", ("parquet", "orc", "csv", "text", "json", "xml"))
    rows, directories = sink_rows(
        df,
        sink_columns=sink_columns,
        partition_by=partition_by,
        is_partition_field_write_in_file=is_partition_field_write_in_file,
    )
    if rebalance:
        rows = rows.hint("rebalance", *directories)
    if fmt == "text":
        # A carriage return is no delimiter, but the writer puts such a value in quotes, of which there are none.
        rows = _plain_texts(rows, directories, field_delimiter or TEXT_DELIMITER, row_delimiter, "\r", "\n")
    writer = rows.write.mode(mode).options(
        **_writer_options(fmt, field_delimiter, row_delimiter, header, null_format, date_format, datetime_format)
    )
    if fmt == "xml":
        writer = writer.options(rowTag=row_tag, rootTag=root_tag)
    if directories:
        writer = writer.partitionBy(*directories)
    writer.format("csv" if fmt == "text" else fmt).save(path)
