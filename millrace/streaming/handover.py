"""One stream that reads a snapshot and then goes over to the changes.

A Python data source whose offset says where the stream stands: at a row of a snapshot file, or behind a position in the
changes. So one checkpoint covers both phases, and a query that is killed in either, or between them, goes on where it
stood. Snapshot and changes are folders of Parquet files; a change row carries its position ``__seq`` (and, for bounds by
time, ``__event_ms``). Files may be added to the changes while the stream runs, with positions above those already read.

The driver reads file footers and, where a rate limit cuts inside a row group, the positions of that row group; rows are
read by the executors, one file or range of rows per task.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from millrace.envelope import EVENT_MS, INSERT, KIND, SEQ
from millrace.options import conditional, single_choice
from millrace.session import ship_package

NAME = "snapshot_then_changes"
START_MODES = ("initial", "earliest", "latest", "specific", "timestamp")
STOP_MODES = ("never", "latest", "specific", "timestamp")

_FOOTER_THREADS = 16
_BATCH_ROWS = 8192


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI; ``file:/x`` is how Hadoop writes a local path."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = path.removeprefix("file:")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _parquet_files(folder: str) -> list[str]:
    fs, root = _open(folder)
    found = fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
    hidden = lambda path: any(part[:1] in "._" for part in path[len(root) :].split("/") if part)
    return sorted(f.path for f in found if f.is_file and not hidden(f.path))


@dataclass(frozen=True)
class Span:
    """Row group of a change file: its rows and least and greatest position."""

    path: str
    group: int
    rows: int
    low: int
    high: int


@dataclass
class Rows(InputPartition):
    """Work of one task: rows of a snapshot file by number (``to`` None: to its end), or rows of a change file by position,
    above ``start`` and up to ``to``."""

    path: str
    snapshot: bool
    start: int
    to: int | None

    def __init__(self, path: str, snapshot: bool, start: int, to: int | None) -> None:
        super().__init__((path, snapshot, start, to))
        self.path, self.snapshot, self.start, self.to = path, snapshot, start, to


class SnapshotThenChanges(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return HandoverReader(schema, json.loads(self.options["settings"]))


class HandoverReader(DataSourceStreamReader):
    """Offsets: ``{"phase": "snapshot", "file": i, "row": r, "position": p, "stop": s}`` before row ``r`` of file ``i``, then
    ``{"phase": "changes", "position": p, "stop": s}`` behind position ``p``; ``stop`` is the last position, or null."""

    def __init__(self, schema: T.StructType, settings: Mapping[str, Any]) -> None:
        self.schema, self.settings = schema, dict(settings)
        self.at: dict | None = None
        self.spans: dict[str, list[Span]] = {}
        self.rows: dict[str, int] = {}
        self._files: list[str] | None = None

    # -- what is there

    def _snapshot(self) -> list[str]:
        """The files of the snapshot, fixed while the stream reads them."""
        if self._files is None:
            self._files = _parquet_files(self.settings["snapshot"])
        return self._files

    def _row_count(self, path: str) -> int:
        if path not in self.rows:
            fs, inside = _open(path)
            with fs.open_input_file(inside) as handle:
                self.rows[path] = pq.read_metadata(handle).num_rows
        return self.rows[path]

    def _changes(self) -> list[Span]:
        """Row groups of all change files. Only the footers of files not seen before are read."""
        fresh = [path for path in _parquet_files(self.settings["changes"]) if path not in self.spans]
        with ThreadPoolExecutor(_FOOTER_THREADS) as pool:
            self.spans.update(zip(fresh, pool.map(_spans, fresh)))
        return [span for spans in self.spans.values() for span in spans]

    def _last_position(self, at_least: int) -> int:
        return max((span.high for span in self._changes()), default=at_least)

    # -- offsets

    def initialOffset(self) -> dict:
        mode, position = self.settings["start_mode"], self.settings["position"]
        if self.settings["stop_mode"] == "latest":
            stop = self._last_position(-1)
        else:
            stop = self.settings["stop_position"]
        if mode == "initial" and self._snapshot():
            return self._in_snapshot(0, 0, -1 if position is None else position, stop)
        if mode == "latest":
            position = self._last_position(-1)
        return self._in_changes(-1 if position is None else position, stop)

    @staticmethod
    def _in_snapshot(file: int, row: int, position: int, stop: int | None) -> dict:
        return {"phase": "snapshot", "file": file, "row": row, "position": position, "stop": stop}

    @staticmethod
    def _in_changes(position: int, stop: int | None) -> dict:
        return {"phase": "changes", "position": position, "stop": stop}

    def latestOffset(self) -> dict:
        """As far as the next batch may go: through the snapshot first, then through the changes there are now, in steps of
        ``rows_per_batch`` where that is given."""
        if self.at is None:
            self.at = self.initialOffset()
        at, limit = self.at, self.settings["rows_per_batch"]
        position, stop = at["position"], at["stop"]
        if at["phase"] == "snapshot":
            file, row, files = at["file"], at["row"], self._snapshot()
            while limit and file < len(files):
                left = self._row_count(files[file]) - row
                if left > limit:
                    return self._in_snapshot(file, row + limit, position, stop)
                file, row, limit = file + 1, 0, limit - left
                if not limit and file < len(files):
                    return self._in_snapshot(file, 0, position, stop)
            return self._in_changes(position, stop)
        end = self._last_position(position)
        end = end if stop is None else min(end, stop)
        if limit and end > position:
            end = self._step(position, end, limit)
        return self._in_changes(max(end, position), stop)

    def _step(self, position: int, end: int, limit: int) -> int:
        """The greatest position up to ``end`` with at most ``limit`` changes behind ``position``. A position that more
        changes share than that is taken whole: a position is never cut."""
        spans = sorted((s for s in self._changes() if s.high > position and s.low <= end), key=lambda s: s.low)
        known = np.empty(0, dtype=np.int64)
        for i, span in enumerate(spans):
            own = _positions(span)
            known = np.sort(np.concatenate([known, own[(own > position) & (own <= end)]]))[: limit + 1]
            # Later row groups begin above what is taken already.
            if len(known) > limit and (i + 1 == len(spans) or spans[i + 1].low > known[-1]):
                break
        if len(known) <= limit:
            return end
        cut = int(known[limit])
        below = known[known < cut]
        return int(below[-1]) if len(below) else cut

    # -- work

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        # Spark asks for the empty range at the last offset when it restarts a query: so the reader knows where it stands.
        self.at = end
        out: list[Rows] = []
        if start["phase"] == "snapshot":
            files = self._snapshot()
            if start["file"] > len(files):
                raise ValueError("the snapshot has fewer files than when the stream began to read it")
            last = (end["file"], end["row"]) if end["phase"] == "snapshot" else (len(files), 0)
            for file in range(start["file"], min(last[0] + 1, len(files))):
                row, to = start["row"] if file == start["file"] else 0, last[1] if file == last[0] else None
                if to is None or to > row:
                    out.append(Rows(files[file], True, row, to))
        if end["phase"] == "changes":
            low, high = start["position"], end["position"]
            paths = {span.path for span in self._changes() if span.high > low and span.low <= high}
            out += [Rows(path, False, low, high) for path in sorted(paths)]
        return out

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(self.schema)
        fs, inside = _open(partition.path)
        with fs.open_input_file(inside) as handle:
            file = pq.ParquetFile(handle)
            found = _snapshot_batches(file, partition) if partition.snapshot else self._change_batches(file, partition)
            for batch in found:
                yield _conformed(batch, schema, partition.snapshot)

    def _change_batches(self, file: pq.ParquetFile, part: Rows) -> Iterator[pa.RecordBatch]:
        groups = [s.group for s in _file_spans(part.path, file) if s.high > part.start and s.low <= part.to]
        for batch in file.iter_batches(_BATCH_ROWS, row_groups=groups):
            seq = batch.column(SEQ)
            keep = pc.and_(pc.greater(seq, part.start), pc.less_equal(seq, part.to))
            for bound, fits in (("timestamp_ms", pc.greater_equal), ("stop_timestamp_ms", pc.less)):
                if self.settings[bound] is not None:
                    keep = pc.and_(keep, fits(batch.column(EVENT_MS), self.settings[bound]))
            yield batch.filter(keep)


def _file_spans(path: str, file: pq.ParquetFile) -> list[Span]:
    """Row groups with the range of their positions, from the statistics, or from the column where there are none."""
    column, out = file.schema_arrow.names.index(SEQ), []
    if file.metadata.num_columns != len(file.schema_arrow.names):  # nested columns: count leaves
        column = next(i for i in range(file.metadata.num_columns) if file.metadata.schema.column(i).path == SEQ)
    for group in range(file.metadata.num_row_groups):
        meta = file.metadata.row_group(group)
        found = meta.column(column).statistics
        if not meta.num_rows:
            continue
        if found is not None and found.has_min_max:
            low, high = found.min, found.max
        else:
            bounds = pc.min_max(file.read_row_group(group, columns=[SEQ]).column(0)).as_py()
            low, high = bounds["min"], bounds["max"]
        if low is None or found is not None and found.has_null_count and found.null_count:
            raise ValueError(f"changes without {SEQ} in {path}")
        out.append(Span(path, group, meta.num_rows, low, high))
    return out


def _spans(path: str) -> list[Span]:
    fs, inside = _open(path)
    with fs.open_input_file(inside) as handle:
        return _file_spans(path, pq.ParquetFile(handle))


def _positions(span: Span) -> np.ndarray:
    fs, inside = _open(span.path)
    with fs.open_input_file(inside) as handle:
        return pq.ParquetFile(handle).read_row_group(span.group, columns=[SEQ]).column(0).to_numpy().astype(np.int64)


def _snapshot_batches(file: pq.ParquetFile, part: Rows) -> Iterator[pa.RecordBatch]:
    """Rows ``start`` to ``to`` of a file; row groups before and after are not opened."""
    to = file.metadata.num_rows if part.to is None else part.to
    first, groups, skipped = 0, [], 0
    for group in range(file.metadata.num_row_groups):
        rows = file.metadata.row_group(group).num_rows
        if first + rows <= part.start:
            skipped += rows
        elif first < to:
            groups.append(group)
        first += rows
    at = skipped
    for batch in file.iter_batches(_BATCH_ROWS, row_groups=groups) if groups else ():
        low, high = max(part.start, at), min(to, at + batch.num_rows)
        if high > low:
            yield batch.slice(low - at, high - low)
        at += batch.num_rows


def _conformed(batch: pa.RecordBatch, schema: pa.Schema, snapshot: bool) -> pa.RecordBatch:
    """The columns of the stream: a snapshot row is an insert at position 0, and a column a file lacks is NULL."""
    columns = []
    for field in schema:
        if snapshot and field.name == KIND:
            column = pa.array([INSERT] * batch.num_rows, field.type)
        elif snapshot and field.name == SEQ:
            column = pa.array(np.zeros(batch.num_rows, dtype=np.int64)).cast(field.type)
        elif field.name in batch.schema.names:
            column = batch.column(field.name)
            if pa.types.is_timestamp(column.type) and column.type != field.type:
                # Spark's files may hold nanoseconds of which microseconds are all that was written.
                column = column.cast(pa.timestamp("us", column.type.tz), safe=False)
            column = column.cast(field.type)
        else:
            column = pa.nulls(batch.num_rows, field.type)
        columns.append(column)
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def scan_snapshot_then_changes(
    spark: SparkSession,
    snapshot: str | None,
    changes: str,
    *,
    schema: T.StructType,
    start_mode: str = "initial",
    position: int | None = None,
    timestamp_ms: int | None = None,
    stop_mode: str = "never",
    stop_position: int | None = None,
    stop_timestamp_ms: int | None = None,
    rows_per_batch: int | None = None,
) -> DataFrame:
    """A stream of ``schema`` plus ``__kind``, ``__seq`` and ``__event_ms``.

    Start: ``initial`` is the whole snapshot as inserts at position 0, then the changes after ``position`` (that of the
    snapshot; all of them where it is not given); ``earliest`` only the changes; ``latest`` those after the last one there
    is when the query first starts; ``specific`` those after ``position``; ``timestamp`` those with ``__event_ms`` from
    ``timestamp_ms`` on. Stop: ``never``; ``latest``, behind the last change there is when the query first starts;
    ``specific``, behind ``stop_position``; ``timestamp``, before ``stop_timestamp_ms``. A restarted query goes on at its
    checkpoint. ``rows_per_batch`` is the most a micro-batch takes in either phase.
    """
    given = {
        "snapshot": snapshot,
        "changes": changes,
        "start_mode": start_mode,
        "position": position,
        "timestamp_ms": timestamp_ms,
        "stop_mode": stop_mode,
        "stop_position": stop_position,
        "stop_timestamp_ms": stop_timestamp_ms,
        "rows_per_batch": rows_per_batch,
    }
    single_choice(given, "start_mode", START_MODES)
    single_choice(given, "stop_mode", STOP_MODES)
    conditional(given, "start_mode", "initial", "snapshot")
    conditional(given, "start_mode", "specific", "position")
    conditional(given, "start_mode", "timestamp", "timestamp_ms")
    conditional(given, "stop_mode", "specific", "stop_position")
    conditional(given, "stop_mode", "timestamp", "stop_timestamp_ms")
    if rows_per_batch is not None and rows_per_batch < 1:
        raise ValueError("a batch takes a row at least")
    ship_package(spark)
    spark.dataSource.register(SnapshotThenChanges)
    envelope = [T.StructField(KIND, T.StringType()), T.StructField(SEQ, T.LongType()), T.StructField(EVENT_MS, T.LongType())]
    return spark.readStream.format(NAME).schema(T.StructType([*schema.fields, *envelope])).option("settings", json.dumps(given)).load()


def drain(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Run a stream until it has taken everything there is, batch after batch, then stop it; a failure is raised here.
    Python sources give an ``availableNow`` trigger a single batch, so this takes their place of it."""
    query = writer.option("checkpointLocation", checkpoint).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    if query.exception() is not None:
        raise query.exception()
    return query
