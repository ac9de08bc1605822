"""Stream sinks: exactly-once files, changelogs into keyed tables, checkpoints."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from millrace.sinks.files import sink_rows
from millrace.sinks.keyed import KeyedTable


_ROUTE = "__route"


def checkpointed(writer: DataStreamWriter, checkpoint: str, interval_ms: int | None = None) -> DataStreamWriter:
    """Attach the checkpoint folder. ``interval_ms`` is the time between consistent snapshots (one per micro-batch);
    without it the query takes what is there now, in as many batches as the rate limit asks, and stops."""
    writer = writer.option("checkpointLocation", checkpoint)
    if interval_ms is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{interval_ms} milliseconds")


def run_to_end(query: StreamingQuery) -> StreamingQuery:
    """Wait for a bounded query; its failure is raised here."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query


def stream_to_files(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    *,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    sink_columns: Sequence[str] | None = None,
    interval_ms: int | None = None,
) -> StreamingQuery:
    """Append to files exactly once: Spark's file sink logs the files of each committed batch, and readers of the
    folder see those only."""
    rows, directories = sink_rows(stream, sink_columns=sink_columns, partition_by=partition_by)
    writer = rows.writeStream.format(fmt).outputMode("append").option("path", path)
    if directories:
        writer = writer.partitionBy(*directories)
    return checkpointed(writer, checkpoint, interval_ms).start()


def stream_for_each(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, *, interval_ms: int | None = None
) -> StreamingQuery:
    """Hand each micro-batch and its id to ``handle``, which must accept the same id twice."""
    return checkpointed(stream.writeStream.foreachBatch(handle), checkpoint, interval_ms).start()


def stream_apply_changelog(
    stream: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    *,
    snapshot: DataFrame | None = None,
    compact_every: int | None = None,
    interval_ms: int | None = None,
) -> StreamingQuery:
    """A changelog stream into a keyed table: the snapshot (if any) is loaded once, then each micro-batch adds its
    folded changes. The batch id makes a replay harmless; the table takes no other stream than that of ``checkpoint``."""
    table.belongs_to(checkpoint.rstrip("/"))
    if snapshot is not None:
        table.load(snapshot)

    def handle(batch: DataFrame, batch_id: int) -> None:
        table.apply(batch, batch_id)
        if compact_every and (batch_id + 1) % compact_every == 0:
            table.compact()

    return stream_for_each(stream, handle, checkpoint, interval_ms=interval_ms)


def stream_route_changelog(
    stream: DataFrame,
    routes: Mapping[str, tuple[Callable[[DataFrame], DataFrame], KeyedTable]],
    checkpoint: str,
    *,
    table_of: Column,
    interval_ms: int | None = None,
) -> StreamingQuery:
    """One stream carrying changes of many tables into one keyed table each.

    ``table_of`` tells a message's table; ``routes`` gives, per table, how its messages are decoded and where they go.
    Messages of other tables are left alone. The micro-batch is read once, and each table parses only its own
    messages.
    """

    for _, table in routes.values():
        table.belongs_to(checkpoint.rstrip("/"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        marked = batch.withColumn(_ROUTE, table_of).where(F.col(_ROUTE).isin(list(routes))).persist()
        try:
            for name, (decode, table) in routes.items():
                table.apply(decode(marked.where(F.col(_ROUTE) == name).drop(_ROUTE)), batch_id)
        finally:
            marked.unpersist()

    return stream_for_each(stream, handle, checkpoint, interval_ms=interval_ms)
