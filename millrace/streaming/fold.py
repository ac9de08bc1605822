"""Folding a changelog inside a stream, with keyed state in place of a table beside it.

For every key the state remembers the place (``__seq``, kind) of its newest change; the keys of a hash bucket share one
state variable, which a batch reads and writes once if it has changes of that bucket. A change that is newer goes on
downstream, as an insert, an update or a delete of the folded table; an older one, however late, does not. What a deleted
key leaves behind is forgotten after a time of its own, so the state grows with the living keys. Each task folds its own
rows before the shuffle, so a key that holds most of the changes costs one row per batch of rows, not all of them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from millrace.envelope import DELETE, INSERT, KIND, SEQ, UPDATE_AFTER, UPDATE_BEFORE, payload_columns, quoted, require_columns
from millrace.operators.changelog import kind_order, known_kinds
from millrace.session import ship_package
from millrace.streaming.sinks import stream_to_files

_PLACE, _RANK, _ID, _SINCE, _BUCKET = "__place", "__rank", "__id", "__since", "__bucket"
_FIRST = -(1 << 63)  # the place of a change without a number: before all others

# What keyed state with a time to live needs: the RocksDB store, and no batches without data, which Spark would run one after
# the other for as long as a query has such state; what is forgotten is looked for when there are changes.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """The settings above while a query is started: it keeps those it began with, other queries keep theirs."""
    before = {key: spark.conf.get(key, None) for key in STATE_SETTINGS}
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def latest_of(batch: pa.Table, keys: Sequence[str]) -> pa.Table:
    """The newest row of each key of an Arrow table."""
    ordered = batch.sort_by([(_PLACE, "ascending"), (_RANK, "ascending")])
    numbered = ordered.select(list(keys)).append_column("__at", pa.array(range(len(ordered)), pa.int64()))
    last = numbered.group_by(list(keys), use_threads=False).aggregate([("__at", "max")])
    return ordered.take(last.column("__at_max"))


class FoldChanges(StatefulProcessor):
    """``live`` holds the places of the newest changes of the living keys of a bucket, ``gone`` those of deleted ones and when
    they went, column by column. A state variable is read and written once for all keys of a bucket: a call for each key
    costs more than the fold."""

    def __init__(self, columns: Sequence[str], deleted_ttl_ms: int | None) -> None:
        self.columns, self.deleted_ttl_ms = list(columns), deleted_ttl_ms
        self.row = Row(*self.columns, KIND, SEQ)

    def init(self, handle: StatefulProcessorHandle) -> None:
        places = f"{_ID} array<string>, {_PLACE} array<long>, {_RANK} array<int>"
        self.live = handle.getValueState("live", places)
        # Each key has its own time; that of the variable is for buckets that no change comes to any more.
        self.gone = handle.getValueState("gone", f"{places}, {_SINCE} array<long>", self.deleted_ttl_ms)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        newest: dict = {}
        for row in rows:
            at, known = (row[_PLACE], row[_RANK]), newest.get(row[_ID])
            if known is None or known[0] < at:
                newest[row[_ID]] = at, row
        now = 0 if self.deleted_ttl_ms is None else timerValues.getCurrentProcessingTimeInMs()
        live = {name: place for name, *place in zip(*(self.live.get() or ()))}
        kept = {name: place for name, *place in zip(*(self.gone.get() or ()))}
        gone = kept if self.deleted_ttl_ms is None else {k: v for k, v in kept.items() if v[2] + self.deleted_ttl_ms > now}
        live_changed, gone_changed = False, len(gone) < len(kept)
        for name, (at, row) in newest.items():
            was = live.get(name)
            known = was or gone.get(name)
            if known is not None and tuple(known[:2]) >= at:
                continue
            if row[KIND] == DELETE:
                gone[name], gone_changed = [*at, now], True
                if was is None:
                    continue  # nothing that went downstream is taken back
                del live[name]
                kind = DELETE
            else:
                if was is None:
                    gone_changed = gone.pop(name, None) is not None or gone_changed
                live[name] = at
                kind = INSERT if was is None else UPDATE_AFTER
            live_changed = True
            yield self.row(*[row[column] for column in self.columns], kind, row[SEQ])
        for state, places, changed in ((self.live, live, live_changed), (self.gone, gone, gone_changed)):
            if changed and places:
                state.update((list(places), *map(list, zip(*places.values()))))
            elif changed:
                state.clear()

    def close(self) -> None:
        pass


def _identity(key: str, kind: T.DataType) -> Column:
    """A key as text that only equal keys share."""
    column = F.col(quoted(key))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        column = column + F.lit(0.0)  # minus zero is zero
    elif isinstance(kind, T.TimestampType):
        column = F.unix_micros(column)
    elif isinstance(kind, T.BinaryType):
        column = F.hex(column)
    elif isinstance(kind, (T.ArrayType, T.StructType)):
        options = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSSXXX"}
        column = F.to_json(F.struct(column), options)
    return column.cast("string")


def fold_stream(
    changes: DataFrame, *, keys: Sequence[str], deleted_ttl_ms: int | None = 7 * 86_400_000, buckets: int = 1 << 12
) -> DataFrame:
    """A changelog stream as the changes of its folded table: ``+I`` where a key appears, ``+U`` where its row is replaced,
    ``-D`` where it goes, each with ``__seq``, and nothing for a change that is older than what is known of its key.

    Before-images are left out; a change without a kind is an error; one without a number comes before all others; keys must
    not be NULL. A deleted key is remembered for ``deleted_ttl_ms`` (None: for ever): a change older than the delete that
    arrives later than that brings the key back. The state of the keys is kept in ``buckets``; a batch reads and writes the
    buckets of its keys, and a checkpoint keeps the number it began with. Start the query inside ``keyed_state``."""
    require_columns(changes, [*keys, SEQ, KIND], "fold_stream")
    ship_package(changes.sparkSession)
    columns = payload_columns(changes)
    names = [_identity(key, changes.schema[key].dataType) for key in keys]
    name = names[0] if len(names) == 1 else F.to_json(F.array(*names))
    placed = (
        known_kinds(changes)
        .where(F.col(KIND) != UPDATE_BEFORE)
        .select(*[F.col(quoted(name)) for name in columns], KIND, F.col(SEQ).cast("long").alias(SEQ))
        .withColumns({_PLACE: F.coalesce(F.col(SEQ), F.lit(_FIRST)), _RANK: kind_order().cast("int"), _ID: name})
    )
    by = list(keys)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from latest_of(pa.Table.from_batches([batch]), by).to_batches()

    combined = placed.mapInArrow(combine, placed.schema)
    folded = T.StructType([*[changes.schema[name] for name in columns], T.StructField(KIND, T.StringType()), T.StructField(SEQ, T.LongType())])
    bucketed = combined.withColumn(_BUCKET, F.pmod(F.xxhash64(_ID), F.lit(buckets)))
    return bucketed.groupBy(_BUCKET).transformWithState(
        FoldChanges(columns, deleted_ttl_ms), folded, "Append", "None" if deleted_ttl_ms is None else "ProcessingTime"
    )


def stream_fold(
    changes: DataFrame,
    path: str,
    checkpoint: str,
    *,
    keys: Sequence[str],
    deleted_ttl_ms: int | None = 7 * 86_400_000,
    interval_ms: int | None = None,
) -> StreamingQuery:
    """The folded changes as files, exactly once. ``fold_changelog`` over them gives the table."""
    folded = fold_stream(changes, keys=keys, deleted_ttl_ms=deleted_ttl_ms)
    with keyed_state(changes.sparkSession):
        return stream_to_files(folded, path, checkpoint, sink_columns=folded.columns, interval_ms=interval_ms)
