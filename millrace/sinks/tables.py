"""Catalog table sinks: save modes, inserts, DDL templates, many tables at once."""

from __future__ import annotations

import re
import threading
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.envelope import TableMeta, TablePath, TableSet, payload_columns, quoted
from millrace.operators.rowkind import sink_types
from millrace.options import require, single_choice

SCHEMA_SAVE_MODES = ("RECREATE_SCHEMA", "CREATE_SCHEMA_WHEN_NOT_EXIST", "ERROR_WHEN_SCHEMA_NOT_EXIST", "IGNORE")
DATA_SAVE_MODES = ("DROP_DATA", "APPEND_DATA", "CUSTOM_PROCESSING", "ERROR_WHEN_DATA_EXISTS")


def table_name(name: str) -> str:
    """A possibly qualified name, each part back-ticked."""
    return ".".join(quoted(part.strip("`")) for part in name.split("."))


def column_ddl(df: DataFrame) -> list[tuple[str, str]]:
    """(name, DDL type) of each payload column; a declared sink type wins."""
    declared = sink_types(df)
    return [
        (name, declared.get(name, df.schema[name].dataType.simpleString())) for name in payload_columns(df)
    ]


def _text(value: str) -> str:
    """A SQL text literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_table(
    df: DataFrame,
    name: str,
    *,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    location: str | None = None,
    comment: str | None = None,
) -> None:
    """An empty table with the DataFrame's columns."""
    columns = []
    for column, kind in column_ddl(df):
        note = df.schema[column].metadata.get("comment")
        columns.append(f"{quoted(column)} {kind}" + (f" COMMENT {_text(note)}" if note else ""))
    ddl = f"CREATE TABLE {table_name(name)} ({', '.join(columns)}) USING {fmt}"
    if partition_by:
        ddl += f" PARTITIONED BY ({', '.join(quoted(column) for column in partition_by)})"
    if comment:
        ddl += f" COMMENT {_text(comment)}"
    if location:
        ddl += f" LOCATION {_text(location)}"
    df.sparkSession.sql(ddl)


_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
_OVERWRITE_LOCK = threading.Lock()


@contextmanager
def _overwrite_mode(spark: SparkSession, mode: str) -> Iterator[None]:
    """A catalog table takes the overwrite mode from the session, not from writer options."""
    with _OVERWRITE_LOCK:
        before = spark.conf.get(_OVERWRITE_MODE)
        spark.conf.set(_OVERWRITE_MODE, mode)
        try:
            yield
        finally:
            spark.conf.set(_OVERWRITE_MODE, before)


def insert_table(df: DataFrame, name: str, *, overwrite: bool = False) -> None:
    """Append by column name to a (partitioned) table; ``overwrite`` replaces only the partitions that have rows."""
    spark = df.sparkSession
    target = spark.table(table_name(name)).schema
    missing = [field.name for field in target.fields if field.name not in df.columns]
    if missing:
        raise ValueError(f"insert_table: the input has no {missing}")
    rows = df.select(*[F.col(quoted(field.name)).cast(field.dataType).alias(field.name) for field in target.fields])
    with _overwrite_mode(spark, "dynamic"):
        rows.write.insertInto(table_name(name), overwrite=overwrite)


def empty_table(spark: SparkSession, name: str) -> None:
    """Drop the data and keep the table. Spark truncates only tables it owns; an external one is overwritten with
    nothing."""
    full = table_name(name)
    if spark.catalog.getTable(full).tableType == "MANAGED":
        spark.sql(f"TRUNCATE TABLE {full}")
        return
    nothing = spark.createDataFrame([], spark.table(full).schema)
    with _overwrite_mode(spark, "static"):
        nothing.write.insertInto(full, overwrite=True)


def prepare_target(
    df: DataFrame,
    name: str,
    *,
    schema_save_mode: str = "CREATE_SCHEMA_WHEN_NOT_EXIST",
    data_save_mode: str = "APPEND_DATA",
    custom_sql: str | None = None,
    restored: bool = False,
    **create_options,
) -> bool:
    """Bring the target table into the state the two modes ask for; true when it was created just now.

    After a restore a table is not recreated: RECREATE_SCHEMA then means create when missing.
    """
    single_choice({"m": schema_save_mode}, "m", SCHEMA_SAVE_MODES)
    single_choice({"m": data_save_mode}, "m", DATA_SAVE_MODES)
    spark = df.sparkSession
    full = table_name(name)
    exists = spark.catalog.tableExists(full)
    if schema_save_mode == "RECREATE_SCHEMA" and exists and not restored:
        spark.sql(f"DROP TABLE {full}")
        exists = False
    created = False
    if not exists:
        if schema_save_mode == "ERROR_WHEN_SCHEMA_NOT_EXIST":
            raise ValueError(f"save mode: table {name} does not exist")
        if schema_save_mode != "IGNORE":
            create_table(df, name, **create_options)
            created = True
    if data_save_mode == "DROP_DATA" and exists and not created:
        empty_table(spark, name)
    elif data_save_mode == "ERROR_WHEN_DATA_EXISTS" and exists and not spark.table(full).isEmpty():
        raise ValueError(f"save mode: table {name} already has data")
    elif data_save_mode == "CUSTOM_PROCESSING":
        require({"custom_sql": custom_sql}, "custom_sql")
        spark.sql(custom_sql)
    return created


def save_table(df: DataFrame, name: str, **modes) -> None:
    """Apply the save modes of :func:`prepare_target`, then append the rows."""
    prepare_target(df, name, **modes)
    insert_table(df, name)


# The placeholders of names that come from a source table.
PLACEHOLDERS = (
    "database_name",
    "schema_name",
    "table_name",
    "schema_full_name",
    "table_full_name",
    "primary_key",
    "unique_key",
    "field_names",
    "comment",
)
_PLACEHOLDER = re.compile(r"\$\{(%s)(?::([^}]*))?\}" % "|".join(PLACEHOLDERS))


def resolve_name(template: str, path: TablePath, df: DataFrame | None = None, meta: TableMeta = TableMeta()) -> str:
    """Fill ``${table_name}`` and friends from a source table. ``${x:default}`` names what stands in for a missing
    part; without a default a missing database, schema or table part is empty, a missing key stays as written."""
    parents = [part for part in (path.database, path.schema) if part]
    values = {
        "database_name": path.database,
        "schema_name": path.schema,
        "table_name": path.table,
        "schema_full_name": ".".join(parents) or None,
        "table_full_name": str(path),
        "primary_key": ",".join(meta.primary_key) or None,
        "unique_key": ",".join(meta.unique_keys[0]) if meta.unique_keys else None,
        "field_names": ",".join(payload_columns(df)) if df is not None else None,
        "comment": meta.comment,
    }

    def fill(match: re.Match) -> str:
        key, default = match.group(1), match.group(2)
        value = values[key] or default
        if value is not None:
            return value
        return "" if key in ("database_name", "schema_name", "table_name") else match.group(0)

    return _PLACEHOLDER.sub(fill, template)


def write_many(
    tables: TableSet,
    write: Callable[[DataFrame, str], None],
    *,
    database: str | None = "${database_name}",
    table: str = "${table_name}",
    at_once: int = 1,
) -> dict[TablePath, str]:
    """One sink per table: ``write(df, resolved name)`` runs for each, ``at_once`` of them side by side (small tables
    then share the cluster); the names are returned."""
    names: dict[TablePath, str] = {}
    for path, df in tables.items():
        meta = tables.meta(path)
        parts = [resolve_name(part, path, df, meta) for part in (database, table) if part]
        names[path] = ".".join(part for part in parts if part)
    if len(set(names.values())) != len(names):
        raise ValueError(f"write_many: several tables would go to one target: {sorted(names.values())}")
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        for done in [pool.submit(write, df, names[path]) for path, df in tables.items()]:
            done.result()
    return names


DEFAULT_TEMPLATE = "CREATE TABLE IF NOT EXISTS `${table}` (\n${rowtype_fields}\n) COMMENT '${comment}'"


def render_template(
    df: DataFrame, template: str = DEFAULT_TEMPLATE, *, table: str, database: str = "", meta: TableMeta = TableMeta()
) -> str:
    """DDL from a template. A column named on its own line in the template gets its type filled in and leaves
    ``${rowtype_fields}``."""
    types = dict(column_ddl(df))
    body = template.split("(", 1)
    used = []

    def fill(match: re.Match) -> str:
        indent, mark, name, rest, comma = match.groups()
        if name not in types:
            return match.group(0)
        used.append(name)
        given = rest.strip()
        kind = "" if given and not given.upper().startswith(("NOT ", "COMMENT", "DEFAULT")) else " " + types[name]
        return f"{indent}`{name}`{kind}{' ' + given if given else ''}{comma}"

    if len(body) == 2:
        body[1] = re.sub(r"(?m)^([ \t]*)(`?)(\w+)`?([^,\n{}]*?)(,?)[ \t]*$", fill, body[1])
        template = "(".join(body)

    def names(columns: Sequence[str]) -> str:
        return ",".join(quoted(column) for column in columns)

    rest = ",\n".join(f"{quoted(name)} {kind}" for name, kind in types.items() if name not in used)
    unique = meta.unique_keys[0] if meta.unique_keys else ()
    values = {
        "database": database,
        "table": table,
        "table_name": table,
        "comment": (meta.comment or "").replace("'", "\\'"),
        "rowtype_primary_key": names(meta.primary_key),
        "rowtype_unique_key": names(unique),
        "rowtype_duplicate_key": names(meta.primary_key or unique or payload_columns(df)[:1]),
        "rowtype_fields": rest,
    }
    if "${rowtype_primary_key}" in template and not meta.primary_key:
        raise ValueError("the template uses ${rowtype_primary_key}, but the table has no primary key")
    if "${rowtype_unique_key}" in template and not unique:
        raise ValueError("the template uses ${rowtype_unique_key}, but the table has no unique key")
    return re.sub(r"\$\{(\w+)\}", lambda m: values.get(m.group(1), m.group(0)), template)


def create_from_template(
    spark: SparkSession, df: DataFrame, template: str = DEFAULT_TEMPLATE, **names
) -> str:
    """Render the template and run it; the statement is returned."""
    statement = render_template(df, template, **names)
    spark.sql(statement)
    return statement


def run_statements(spark: SparkSession, statements: Sequence[str], args: Mapping[str, object] | None = None) -> DataFrame:
    """Run Spark SQL statements in order (views over sources, CTAS, INSERT INTO ... SELECT); the last one's result is
    returned."""
    result = None
    for statement in statements:
        result = spark.sql(statement, args=dict(args)) if args else spark.sql(statement)
    if result is None:
        raise ValueError("run_statements: no statements")
    return result
