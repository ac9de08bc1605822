"""Row counts of a job, per table."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from millrace.envelope import TablePath, TableSet, quoted

COUNTS_SCHEMA = (
    "table string, source_received_count bigint, source_received_bytes bigint, source_received_qps double,"
    " sink_write_count bigint, sink_write_bytes bigint, sink_write_qps double,"
    " sink_committed_count bigint, sink_committed_bytes bigint"
)

# Bytes of a value of each fixed-width type.
WIDTHS = {
    "boolean": 1,
    "tinyint": 1,
    "smallint": 2,
    "int": 4,
    "bigint": 8,
    "float": 4,
    "double": 8,
    "date": 4,
    "timestamp": 8,
    "timestamp_ntz": 8,
}


def row_bytes(df: DataFrame) -> Column:
    """The size of a row's values: widths of fixed types, byte lengths of texts, JSON length of nested values."""
    total = F.lit(0).cast("bigint")
    for field in df.schema.fields:
        value, kind = F.col(quoted(field.name)), field.dataType.simpleString()
        if kind in WIDTHS:
            size = F.when(value.isNotNull(), WIDTHS[kind])
        elif isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = F.octet_length(value)
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = F.octet_length(F.to_json(value))
        else:
            size = F.octet_length(value.cast("string"))
        total = total + F.coalesce(size, F.lit(0))
    return total


def _measures(df: DataFrame) -> tuple[Column, Column]:
    return F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")


def job_counts(
    tables: TableSet, transform: Callable[[TablePath, DataFrame], DataFrame], write: Callable[[TablePath, DataFrame], None]
) -> DataFrame:
    """Run each table through ``transform`` into ``write`` and report rows, bytes and rates received, written and
    committed. The counts ride along with the write (``observe``): no second pass, no count job. A write that returns
    has committed all it wrote."""
    counted = []
    for path, df in tables.items():
        received, written = Observation(), Observation()
        out = transform(path, df.observe(received, *_measures(df)))
        started = time.monotonic()
        write(path, out.observe(written, *_measures(out)))
        seconds = max(time.monotonic() - started, 1e-3)
        took, gave = received.get, written.get
        counted.append(
            (str(path), took["n"], took["bytes"], took["n"] / seconds)
            + (gave["n"], gave["bytes"], gave["n"] / seconds, gave["n"], gave["bytes"])
        )
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(counted, COUNTS_SCHEMA)


class StreamTotals(StreamingQueryListener):
    """Adds up every progress report of every query of a session, however long it runs. Spark itself keeps the last
    hundred."""

    def __init__(self) -> None:
        self.totals: dict[str, dict[str, float]] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        self.totals[str(event.runId)] = dict.fromkeys(("batches", "source_received", "source_received_qps", "sink_write_qps"), 0)

    def onQueryProgress(self, event) -> None:
        own, report = self.totals[str(event.progress.runId)], event.progress
        own["batches"] += 1
        own["source_received"] += report.numInputRows
        own["source_received_qps"] = max(own["source_received_qps"], report.inputRowsPerSecond or 0.0)
        own["sink_write_qps"] = max(own["sink_write_qps"], report.processedRowsPerSecond or 0.0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))


def count_streams(spark: SparkSession) -> StreamTotals:
    """Start counting; queries started from now on are counted in full."""
    totals = StreamTotals()
    spark.streams.addListener(totals)
    return totals


def stream_counts(query: StreamingQuery, totals: StreamTotals, timeout_s: float = 30.0) -> dict[str, float]:
    """Totals and rates of a streaming query since its start. For a query that has ended, all its reports are awaited."""
    run = str(query.runId)
    if run not in totals.totals:
        raise ValueError("the query was started before count_streams")
    deadline = time.monotonic() + timeout_s
    while not query.isActive and run not in totals.ended:
        if time.monotonic() > deadline:
            raise TimeoutError("the last reports of the query have not come")
        time.sleep(0.05)
    return dict(totals.totals[run])
