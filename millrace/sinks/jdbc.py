"""JDBC sinks: append, one user statement per row, keyed upsert."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, functions as F

from millrace.envelope import DELETE, KIND, SEQ, payload_columns, quoted
from millrace.operators.changelog import latest_changes
from millrace.operators.rowkind import sink_types, with_kind


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    *,
    mode: str = "append",
    batch_size: int = 1000,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Append (or create) by generated inserts, in batches, from every task."""
    options = {"batchsize": str(batch_size), **(properties or {})}
    declared = sink_types(df)
    if declared:
        options["createTableColumnTypes"] = ", ".join(f"{name} {kind}" for name, kind in declared.items())
    df.select(*[F.col(quoted(n)) for n in payload_columns(df)]).write.format("jdbc").options(
        url=url, dbtable=table, **options
    ).mode(mode).save()


def write_statement(
    df: DataFrame, connect: Callable[[], Any], statement: str, *, columns: Sequence[str] | None = None, batch_size: int = 1000
) -> None:
    """Run a user statement for each row over a Python database connection made inside each task.

    ``connect`` returns a DB-API connection. Each batch is one ``executemany`` and one commit; a retried task runs its
    statements again, so they should be idempotent.
    """
    names = list(columns or payload_columns(df))

    def run(rows: Iterator) -> None:
        connection = connect()
        try:
            cursor, waiting = connection.cursor(), []
            for row in rows:
                waiting.append(tuple(row[name] for name in names))
                if len(waiting) >= batch_size:
                    cursor.executemany(statement, waiting)
                    connection.commit()
                    waiting = []
            if waiting:
                cursor.executemany(statement, waiting)
                connection.commit()
        finally:
            connection.close()

    df.select(*[F.col(quoted(name)) for name in names]).foreachPartition(run)


def merge_statements(table: str, staging: str, columns: Sequence[str], keys: Sequence[str]) -> list[str]:
    """The two statements that bring folded staging rows (kind in ``mr_kind``) into the target."""
    on = " AND ".join(f"t.{key} = s.{key}" for key in keys)
    others = [column for column in columns if column not in keys]
    update = ", ".join(f"{column} = s.{column}" for column in others)
    merge = (
        f"MERGE INTO {table} t USING {staging} s ON {on}"
        f" WHEN MATCHED AND s.mr_kind = '{DELETE}' THEN DELETE"
        + (f" WHEN MATCHED THEN UPDATE SET {update}" if others else "")
        + f" WHEN NOT MATCHED AND s.mr_kind <> '{DELETE}' THEN INSERT ({', '.join(columns)})"
        f" VALUES ({', '.join('s.' + column for column in columns)})"
    )
    return [merge, f"DROP TABLE {staging}"]


def upsert_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    *,
    primary_keys: Sequence[str],
    properties: Mapping[str, str] | None = None,
    batch_size: int = 1000,
) -> None:
    """Keyed upsert and delete on a remote table: the folded changes are written to a staging table by all tasks, then
    the driver issues one MERGE. Running it again with the same changes leaves the same table."""
    changes = df if KIND in df.columns else with_kind(df)
    if SEQ not in changes.columns:
        changes = changes.withColumn(SEQ, F.lit(0).cast("bigint"))
    last = latest_changes(changes, keys=primary_keys)
    columns = payload_columns(df)
    staging = f"mr_stage_{uuid.uuid4().hex[:16]}"
    staged = last.select(*[F.col(quoted(name)) for name in columns], F.col(KIND).alias("mr_kind"))
    write_jdbc(staged, url, staging, mode="error", batch_size=batch_size, properties=properties)
    jvm = df.sparkSession._jvm
    settings = jvm.java.util.Properties()
    for key, value in (properties or {}).items():
        settings.setProperty(key, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        statement = connection.createStatement()
        for text in merge_statements(table, staging, columns, primary_keys):
            statement.execute(text)
    finally:
        connection.close()
