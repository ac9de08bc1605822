"""Stream scans: file streams and message topics, start and stop positions, rate limits."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.envelope import quoted
from millrace.options import conditional, single_choice

START_MODES = ("EARLIEST", "LATEST", "SUBSCRIPTION", "TIMESTAMP")
STOP_MODES = ("NEVER", "LATEST", "TIMESTAMP")


def rate_limit_options(
    source: str,
    *,
    rows_per_second: int | None = None,
    bytes_per_second: int | None = None,
    files_per_trigger: int | None = None,
    trigger_seconds: float = 1.0,
) -> dict[str, str]:
    """A read rate as the source's per-trigger cap. The cap holds for the whole query, not per reader."""
    single_choice({"source": source}, "source", ("files", "kafka"))
    options = {}
    if source == "kafka":
        if rows_per_second:
            options["maxOffsetsPerTrigger"] = str(max(1, int(rows_per_second * trigger_seconds)))
        return options
    if bytes_per_second:
        options["maxBytesPerTrigger"] = str(max(1, int(bytes_per_second * trigger_seconds)))
    elif files_per_trigger:
        options["maxFilesPerTrigger"] = str(files_per_trigger)
    elif rows_per_second:
        raise ValueError("a file stream is limited by bytes or files; rows are limited at the topic source")
    return options


def topic_options(
    servers: str,
    topic: str,
    *,
    start_mode: str = "LATEST",
    start_timestamp_ms: int | None = None,
    stop_mode: str = "NEVER",
    stop_timestamp_ms: int | None = None,
    pattern: bool = False,
    **rate: Any,
) -> dict[str, str]:
    """Options of the Kafka source for a start and a stop position. SUBSCRIPTION continues from the checkpoint, which
    a restarted query always does; without one it starts at the earliest message. A stop position makes a bounded
    (batch) read."""
    given = {"start_mode": start_mode, "start_ts": start_timestamp_ms, "stop_mode": stop_mode, "stop_ts": stop_timestamp_ms}
    single_choice(given, "start_mode", START_MODES)
    single_choice(given, "stop_mode", STOP_MODES)
    conditional(given, "start_mode", "TIMESTAMP", "start_ts")
    conditional(given, "stop_mode", "TIMESTAMP", "stop_ts")
    options = {"kafka.bootstrap.servers": servers, "subscribePattern" if pattern else "subscribe": topic}
    if start_mode == "TIMESTAMP":
        options["startingTimestamp"] = str(start_timestamp_ms)
    else:
        options["startingOffsets"] = "latest" if start_mode == "LATEST" else "earliest"
    if stop_mode == "LATEST":
        options["endingOffsets"] = "latest"
    elif stop_mode == "TIMESTAMP":
        options["endingTimestamp"] = str(stop_timestamp_ms)
    options.update(rate_limit_options("kafka", **rate))
    return options


def scan_topic(spark: SparkSession, servers: str, topic: str, **positions: Any) -> DataFrame:
    """A topic as key, value, topic, partition, offset, timestamp; a stream unless a stop position bounds it."""
    options = topic_options(servers, topic, **positions)
    bounded = positions.get("stop_mode", "NEVER") != "NEVER"
    return (spark.read if bounded else spark.readStream).format("kafka").options(**options).load()


def scan_stream(
    spark: SparkSession,
    path: str,
    *,
    fmt: str = "parquet",
    schema: T.StructType,
    event_time: str | None = None,
    start_mode: str = "EARLIEST",
    start_timestamp: str | None = None,
    stop_mode: str = "NEVER",
    stop_timestamp: str | None = None,
    file_glob: str | None = None,
    reader_options: Mapping[str, str] | None = None,
    **rate: Any,
) -> DataFrame:
    """A folder of files as a message stream. Timestamps bound the event-time column (start included, stop excluded);
    a LATEST stop means running the query with an ``availableNow`` trigger."""
    given = {
        "start_mode": start_mode,
        "stop_mode": stop_mode,
        "start_timestamp": start_timestamp,
        "stop_timestamp": stop_timestamp,
        "event_time": event_time,
    }
    single_choice(given, "start_mode", ("EARLIEST", "SUBSCRIPTION", "TIMESTAMP"))
    single_choice(given, "stop_mode", STOP_MODES)
    conditional(given, "start_mode", "TIMESTAMP", "start_timestamp", "event_time")
    conditional(given, "stop_mode", "TIMESTAMP", "stop_timestamp", "event_time")
    reader = spark.readStream.schema(schema).options(**(reader_options or {})).options(**rate_limit_options("files", **rate))
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    df = reader.format(fmt).load(path)
    for mode, bound, keep in (
        (start_mode, start_timestamp, lambda c, b: c >= b),
        (stop_mode, stop_timestamp, lambda c, b: c < b),
    ):
        if mode == "TIMESTAMP":
            column = F.col(quoted(event_time))
            df = df.where(keep(column, F.lit(bound).cast(schema[event_time].dataType)))
    return df
