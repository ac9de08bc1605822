"""Row shaping for remote sinks: JSON payload batches, document ids, console."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from millrace.envelope import payload_columns, quoted, require_columns


def document_id(df: DataFrame, *, primary_keys: Sequence[str], delimiter: str = "_", output: str = "_id") -> DataFrame:
    """A document id from the key columns."""
    require_columns(df, primary_keys, "document_id")
    keys = [F.col(quoted(key)).cast("string") for key in primary_keys]
    return df.withColumn(output, F.concat_ws(delimiter, *keys))


def pack_json_batches(df: DataFrame, *, batch_size: int = 1, array_mode: bool = False) -> DataFrame:
    """Request bodies: column ``body`` and ``n_rows``. One JSON object per row, or JSON arrays of up to
    ``batch_size`` rows. Rows are made into JSON on the JVM; batches form inside each task, so there is no shuffle and
    a task has at most one short batch."""
    row = F.to_json(F.struct(*[F.col(quoted(name)) for name in payload_columns(df)]), {"ignoreNullFields": "false"})
    objects = df.select(row.alias("body"))
    if not array_mode:
        return objects.withColumn("n_rows", F.lit(1).cast("bigint"))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[str] = []
        for batch in batches:
            waiting.extend(batch["body"])
            full = len(waiting) // batch_size * batch_size
            chunks = [waiting[i : i + batch_size] for i in range(0, full, batch_size)]
            waiting = waiting[full:]
            if chunks:
                yield pd.DataFrame({"body": ["[" + ",".join(c) + "]" for c in chunks], "n_rows": [len(c) for c in chunks]})
        if waiting:
            yield pd.DataFrame({"body": ["[" + ",".join(waiting) + "]"], "n_rows": [len(waiting)]})

    return objects.mapInPandas(pack, "body string, n_rows bigint")


def console(df: DataFrame, *, print_data: bool = True, rows: int = 20) -> None:
    """Print the schema and, unless switched off, the first rows."""
    df.printSchema()
    if print_data:
        df.show(rows, truncate=False)
