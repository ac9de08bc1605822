"""A keyed table kept as levels of plain Parquet files under a manifest.

A micro-batch writes only its own folded changes, one folder on level 0, and commits a manifest that names it with the
range of its keys, its rows and its bytes. Every level below holds pieces with disjoint key ranges and may be ``fan`` times
as large as the one above. When level 0 is full its folders are merged into level 1, and a level that is too large hands
pieces on to the next: a merge reads and replaces only the pieces whose ranges overlap, and a piece that overlaps nothing
moves without being read. So the work of a batch grows with its changes, not with the table or the number of batches, and
no folder is ever listed to find out what counts.

A manifest is one small file per commit, seen whole or not at all; what it does not name does not exist. A repeated batch
changes nothing: finished batches are in the manifest, the files of an unfinished one are in none. What a merge replaced
stays for ``retention_seconds``, for readers that still use it, and is then deleted. A table belongs to one stream and its
checkpoint, whose name is stored with it: batch ids are what tells batches apart, so another stream is refused. Inside a
key the order is ``__seq``, then the batch; deletes are kept, so that a late change meets what it is older than.
"""

from __future__ import annotations

import json
import time
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass, field
from decimal import Decimal
from functools import reduce
from itertools import accumulate
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.envelope import DELETE, INSERT, KIND, SEQ, quoted
from millrace.operators.changelog import latest_changes
from millrace.session import list_paths, written
from millrace.storage import CommitLog, modified_ms, read_text, remove, write_text

_BATCH = "__batch"
_RANGE = "__range"
# Stretches of keys that a merge keeps apart; more would only make its expression longer.
_MOST_RANGES = 64
# What the rows of one range may take before they are packed into a file, about: packed ones may be a tenth of it.
_TASK_BYTES = 128 << 20


@dataclass(frozen=True)
class Run:
    """A folder of one batch (level 0) or one file: where it is, the least and greatest first key, rows and bytes."""

    path: str
    low: Any
    high: Any
    rows: int
    bytes: int

    def meets(self, low: Any, high: Any) -> bool:
        """Whether the range from ``low`` to ``high``, both open where None, has keys of this one."""
        below = high is not None and self.low is not None and high < self.low
        above = low is not None and self.high is not None and low > self.high
        return not (below or above)


@dataclass
class Manifest:
    """What a table consists of. Level 0 is written into the manifest, each deeper one into a list of its own that is
    written again only when the level changes."""

    version: int = -1
    owner: str | None = None
    loaded: bool = False
    done: list[list[int]] = field(default_factory=list)  # ranges of finished batches
    levels: list[list[Run]] = field(default_factory=lambda: [[]])
    lists: list[str | None] = field(default_factory=lambda: [None])
    replaced: list[list] = field(default_factory=list)  # paths and when they were replaced, None until the next commit

    def finished(self, batch: int) -> bool:
        return any(low <= batch <= high for low, high in self.done)

    def finish(self, batch: int) -> None:
        ranges = sorted([*self.done, [batch, batch]])
        self.done = ranges[:1]
        for low, high in ranges[1:]:
            if low <= self.done[-1][1] + 1:
                self.done[-1][1] = max(high, self.done[-1][1])
            else:
                self.done.append([low, high])

    def put(self, level: int, runs: list[Run]) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
            self.lists.append(None)
        if self.lists[level]:
            self.replaced.append([self.lists[level], None])
        self.levels[level], self.lists[level] = runs, None

    def deepest(self) -> int:
        return max((i for i, runs in enumerate(self.levels) if runs), default=0)


@dataclass(frozen=True)
class Measure:
    """How a key is measured for ranges: an expression with a JSON value, that value in Python, and the key it stands for."""

    of: Callable[[Column], Column]
    decode: Callable[[Any], Any]
    key: Callable[[Column], Column]


def _measure(kind: T.DataType) -> Measure | None:
    """None for types whose order is not told here: their runs overlap with everything."""
    same = lambda c: c
    if isinstance(kind, T.IntegralType):
        return Measure(lambda c: c.cast("long"), int, same)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return Measure(lambda c: c.cast("double"), float, same)
    if isinstance(kind, T.DecimalType):
        return Measure(lambda c: c.cast("string"), Decimal, same)
    if isinstance(kind, T.StringType):
        return Measure(same, str, same)
    if isinstance(kind, T.DateType):
        return Measure(F.unix_date, int, lambda c: F.date_from_unix_date(c.cast("int")))
    if isinstance(kind, T.TimestampType):
        return Measure(F.unix_micros, int, F.timestamp_micros)
    if isinstance(kind, T.BinaryType):
        return Measure(F.hex, str, F.unhex)
    return None


def _stretches(runs: Iterable[Run]) -> list[list]:
    """The key ranges of ``runs`` with overlapping ones joined, in order; one open range where a run's is not known."""
    out: list[list] = []
    runs = list(runs)
    if any(run.low is None for run in runs):
        return [[None, None]]
    for run in sorted(runs, key=lambda run: run.low):
        if out and run.low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], run.high)
        else:
            out.append([run.low, run.high])
    return out


def overlapping(runs: Sequence[Run], others: Sequence[Run]) -> list[Run]:
    """Those of ``runs`` whose keys may also be in ``others``."""
    stretches = _stretches(others)
    if not stretches or stretches[0][0] is None:
        return list(runs) if stretches else []
    ends = [high for _, high in stretches]

    def meets(run: Run) -> bool:
        if run.low is None:
            return True
        at = bisect_left(ends, run.low)  # the first stretch that does not end before the run
        return at < len(ends) and run.meets(*stretches[at])

    return [run for run in runs if meets(run)]


def _without(runs: Iterable[Run], others: Iterable[Run]) -> list[Run]:
    gone = {run.path for run in others}
    return [run for run in runs if run.path not in gone]


def _met_bytes(below: Sequence[Run]) -> Callable[[Run], int]:
    """How many bytes of ``below`` a run overlaps; ``below`` has disjoint ranges, so a run meets neighbours."""
    if any(run.low is None for run in below):
        return lambda run: 0
    below = sorted(below, key=lambda run: run.low)
    lows, highs = [run.low for run in below], [run.high for run in below]
    sums = [0, *accumulate(run.bytes for run in below)]
    return lambda run: max(0, sums[bisect_right(lows, run.high)] - sums[bisect_left(highs, run.low)])


class KeyedTable:
    """``arrival_order`` lets a later batch win whatever its sequence numbers, for streams whose ``__seq`` starts again.

    ``fan`` is how many folders level 0 takes and how much larger each level is than the one above, ``piece_bytes`` the
    size of a piece (one task writes one)."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        *,
        keys: Sequence[str],
        schema: T.StructType,
        arrival_order: bool = False,
        fan: int = 8,
        piece_bytes: int = 128 << 20,
        retention_seconds: int = 86_400,
    ):
        if fan < 2 or piece_bytes < 1:
            raise ValueError("a keyed table needs a fan of two at least and pieces of some bytes")
        self.spark, self.path, self.keys, self.schema = spark, path.rstrip("/"), list(keys), schema
        self.order = [_BATCH, SEQ] if arrival_order else [SEQ, _BATCH]
        self.fan, self.piece_bytes, self.retention_seconds = fan, piece_bytes, retention_seconds
        self._measured = _measure(schema[self.keys[0]].dataType)
        self.commits = CommitLog(spark, f"{self.path}/manifest")

    # -- the manifest

    def manifest(self) -> Manifest:
        """The newest commit."""
        _, known = self.commits.newest()
        if known is None:
            return Manifest()
        level0 = [self._run(r) for r in known.pop("level0")]
        out = Manifest(**known, levels=[level0])
        for name in out.lists[1:]:
            listed = json.loads(read_text(self.spark, f"{self.path}/{name}")) if name else []
            out.levels.append([self._run(r) for r in listed])
        return out

    def _run(self, stored: dict) -> Run:
        decode = self._measured.decode if self._measured else str
        bounds = {k: None if stored[k] is None else decode(stored[k]) for k in ("low", "high")}
        return Run(**{**stored, **bounds})

    def _json(self, run: Run) -> dict:
        return {k: str(v) if isinstance(v, Decimal) else v for k, v in asdict(run).items()}

    def _commit(self, new: Manifest) -> None:
        """Write ``new`` as the next commit; what was replaced long enough ago goes first, no commit names it any more."""
        now = int(time.time() * 1000)
        expired = [path for path, since in new.replaced if since is not None and now - since >= self.retention_seconds * 1000]
        if expired:
            new.replaced = [entry for entry in new.replaced if entry[0] not in set(expired)]
            self._delete(expired, new)
        new.replaced = [[path, now if since is None else since] for path, since in new.replaced]
        new.version += 1
        for level, runs in enumerate(new.levels):
            if level and runs and new.lists[level] is None:
                new.lists[level] = f"manifest/level{level}-{uuid.uuid4().hex}.list"
                write_text(self.spark, f"{self.path}/{new.lists[level]}", json.dumps([self._json(r) for r in runs]))
        body = {k: v for k, v in vars(new).items() if k != "levels"}
        body["level0"] = [self._json(r) for r in new.levels[0]]
        self.commits.commit(new.version, body)

    def _delete(self, paths: list[str], left: Manifest) -> None:
        folder = lambda path: "/".join(path.split("/")[:2])
        used = {folder(r.path) for runs in left.levels for r in runs} | {folder(path) for path, _ in left.replaced}
        for path in {path if folder(path) in used else folder(path) for path in paths}:
            remove(self.spark, f"{self.path}/{path}")

    def _replace(self, new: Manifest, paths: Iterable[str]) -> None:
        new.replaced += [[path, None] for path in paths]

    def vacuum(self) -> None:
        """Delete what no commit names and is older than the retention time: the files of broken-off writes. This alone
        lists the table's folder."""
        known = self.manifest()
        named = {"/".join(p.split("/")[:2]) for p in [r.path for runs in known.levels for r in runs] + [p for p, _ in known.replaced]}
        lists = {name for name in known.lists if name}
        before = time.time() * 1000 - self.retention_seconds * 1000
        for found in list_paths(self.spark, f"{self.path}/runs/*") + list_paths(self.spark, f"{self.path}/manifest/*.list"):
            name = "/".join(found.split("/")[-2:])
            if name not in named and name not in lists and modified_ms(self.spark, found) <= before:
                remove(self.spark, found)

    def belongs_to(self, stream: str) -> None:
        """Bind the table to a stream (the name of its checkpoint); raises if it is bound to another one."""
        known = self.manifest()
        if known.owner is None:
            known.owner = stream
            self._commit(known)
        elif known.owner != stream:
            raise ValueError(f"the table at {self.path} belongs to the stream {known.owner!r}, not {stream!r}")

    # -- rows in files

    def _stored(self) -> T.StructType:
        return T.StructType(
            [
                *self.schema.fields,
                T.StructField(KIND, T.StringType()),
                T.StructField(SEQ, T.LongType()),
                T.StructField(_BATCH, T.LongType()),
            ]
        )

    def _open(self, runs: Sequence[Run]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], self._stored())
        return self.spark.read.schema(self._stored()).parquet(*[f"{self.path}/{run.path}" for run in runs])

    def _write(self, rows: DataFrame, by: Sequence[str] = ()) -> str:
        folder = f"runs/{uuid.uuid4().hex}"
        rows.select(*self._stored().names, *by).write.partitionBy(*by).parquet(f"{self.path}/{folder}")
        return folder

    def _runs(self, folder: str, *, one: bool) -> list[Run]:
        """The files of a folder as runs, or the folder as ``one``; only the key column is read."""
        rows = self.spark.read.schema(self._stored()).parquet(f"{self.path}/{folder}")
        key, file = F.col(quoted(self.keys[0])), F.col("_metadata.file_path")
        by_file = rows.groupBy(file.alias("file")).agg(
            F.count(F.lit(1)).alias("rows"),
            F.min(key).alias("low"),
            F.max(key).alias("high"),
            F.max("_metadata.file_size").alias("bytes"),
        )
        path = F.lit(folder) if one else F.concat(F.lit(f"{folder}/"), F.substring_index("file", f"{folder}/", -1))
        found = by_file.groupBy(path.alias("path")).agg(
            F.sum("rows").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("bytes").alias("bytes")
        )
        # Ends are found in the order of the key and measured then: a measure need not be in that order as a value.
        measured = self._measured.of if self._measured else lambda c: F.lit(None).cast("string")
        found = found.withColumns({c: measured(F.col(c)) for c in ("low", "high")})
        return sorted((self._run(r.asDict()) for r in found.collect()), key=lambda run: run.path)

    def _range(self, runs: Sequence[Run]) -> Column:
        """The number of the stretch of overlapping runs a key is in, so that no file spans the gap between two."""
        if not self._measured:
            return F.lit(0)
        kind, key = self.schema[self.keys[0]].dataType, F.col(quoted(self.keys[0]))
        starts = [self._measured.key(F.lit(low)).cast(kind) for low, _ in _stretches(runs)[1 : _MOST_RANGES + 1]]
        return F.size(F.filter(F.array(*starts), lambda start: start <= key)) if starts else F.lit(0)

    def _pieces(self, rows: DataFrame, size: int, count: int, runs: Sequence[Run] = ()) -> list[Run]:
        """The last change of each key of ``rows``, cut into key ranges, one file each. No key has more rows than there are
        ``runs``, so no range is heavier than others. The ranges are made first: one shuffle serves them and the fold."""
        by = [F.col(_RANGE), *(F.col(quoted(key)) for key in self.keys)]
        many = max(1, -(-size // self.piece_bytes), -(-count * self._row_bytes() // _TASK_BYTES))
        ranged = rows.withColumn(_RANGE, self._range(runs)).repartitionByRange(many, *by[1:])
        if runs:
            ranged = latest_changes(ranged, keys=self.keys, order_by=self.order)
        return self._runs(self._write(ranged.sortWithinPartitions(*by), [_RANGE]), one=False)

    def _row_bytes(self) -> int:
        """About what a row takes in memory: texts and nested values as twenty bytes, and what Spark keeps beside a row."""
        return 16 + sum(8 if _measure(f.dataType) and not isinstance(f.dataType, (T.StringType, T.BinaryType)) else 28 for f in self._stored())

    # -- writing

    def load(self, snapshot: DataFrame) -> None:
        """The initial snapshot; it precedes every batch. A table that has one already keeps it, so a restarted stream
        may pass it again."""
        new = self.manifest()
        if new.loaded:
            return
        rows = snapshot.select(*[F.col(quoted(f.name)).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        first = rows.withColumns(
            {KIND: F.lit(INSERT), SEQ: F.lit(None).cast("bigint"), _BATCH: F.lit(-1).cast("bigint")}
        )
        # Spark's own estimate; where it has none, its number of shuffle partitions serves.
        size = int(str(snapshot._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        if size > 1 << 60:
            size = self.piece_bytes * int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        pieces = self._pieces(first, size, snapshot.count())
        level = 1
        while sum(run.bytes for run in pieces) > self._room(level):
            level += 1
        new.put(max(level, new.deepest()), [*pieces, *(new.levels[level] if level < len(new.levels) else [])])
        new.loaded = True
        self._commit(new)

    def apply(self, changes: DataFrame, batch_id: int) -> None:
        """Record one batch, the last change per key. Safe to repeat with the same batch id."""
        new = self.manifest()
        if new.finished(batch_id):
            return
        last = latest_changes(changes, keys=self.keys)
        columns = [F.col(quoted(f.name)).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        stored = last.select(*columns, KIND, F.col(SEQ).cast("bigint").alias(SEQ), F.lit(batch_id).cast("bigint").alias(_BATCH))
        new.put(0, new.levels[0] + self._runs(self._write(stored), one=True))
        new.finish(batch_id)
        self._commit(new)
        if len(new.levels[0]) >= self.fan:
            self._merge(new, 0, new.levels[0], self._target(new))
            self._level(new)

    def _target(self, new: Manifest) -> int:
        """The level that what is on level 0 goes to: a level is passed by, and merged along, if what comes is too much for
        the one below it as well."""
        level, size = 1, sum(run.bytes for run in new.levels[0])
        while size > self._room(level + 1):
            size += sum(run.bytes for run in new.levels[level]) if level < len(new.levels) else 0
            level += 1
        return level

    def _room(self, level: int) -> int:
        return self.piece_bytes * self.fan**level

    def _level(self, new: Manifest) -> None:
        """Hand pieces on while a level is too large, those first that meet the fewest bytes below."""
        level = 1
        while level < len(new.levels):
            over = sum(run.bytes for run in new.levels[level]) - self._room(level)
            if over > 0:
                below = new.levels[level + 1] if level + 1 < len(new.levels) else []
                given = []
                for run in sorted(new.levels[level], key=_met_bytes(below)):
                    if over <= 0:
                        break
                    given.append(run)
                    over -= run.bytes
                self._merge(new, level, given)
            level += 1

    def _merge(self, new: Manifest, level: int, runs: list[Run], to: int | None = None) -> None:
        """Merge ``runs`` of a level, and all of the levels between, into the next one or the one given, and commit. Only
        overlapping pieces there are read and replaced."""
        to = level + 1 if to is None else to
        between = [run for levels in new.levels[level + 1 : to] for run in levels]
        runs = [*runs, *between]
        below = new.levels[to] if to < len(new.levels) else []
        met = overlapping(below, runs)
        # A piece that meets nothing moves as it is; folders of level 0 may overlap each other, so those are rewritten.
        rewritten = overlapping(runs, met) if level and not between else runs
        moved, read = _without(runs, rewritten), [*rewritten, *met]
        size, count = sum(run.bytes for run in read), sum(run.rows for run in read)
        pieces = self._pieces(self._open(read), size, count, read) if read else []
        for i in range(level, min(to, len(new.levels))):
            if i == level or new.levels[i]:
                new.put(i, _without(new.levels[i], runs))
        new.put(to, [*_without(below, met), *moved, *pieces])
        self._replace(new, [run.path for run in read])
        self._commit(new)

    def compact(self) -> None:
        """Merge every level down to the deepest one. Pieces no change overlaps stay as they are."""
        new = self.manifest()
        bottom = max(1, new.deepest())
        for level in range(bottom):
            if new.levels[level]:
                self._merge(new, level, new.levels[level])

    # -- reading

    def read(self, low: Any = None, high: Any = None) -> DataFrame:
        """The table now, or its rows with the first key from ``low`` to ``high``; only files whose ranges meet them are
        opened. Files that no change overlaps are read as they are, without a join."""
        known = self.manifest()
        bounds = [self._value(low), self._value(high)]
        levels = [[run for run in runs if run.meets(*bounds)] for runs in known.levels]
        bottom = max((i for i, runs in enumerate(levels) if runs), default=0)
        upper = [run for runs in levels[:bottom] for run in runs] if bottom else levels[0]
        base = levels[bottom] if bottom else []
        touched = overlapping(base, upper)
        parts = [self._open(_without(base, touched))] if len(touched) < len(base) else []
        if upper:
            parts.append(self._folded(upper, touched, low, high))
        rows = reduce(DataFrame.unionByName, parts) if parts else self._open([])
        return self._between(rows, low, high).where(F.col(KIND) != DELETE).select(*[F.col(quoted(name)) for name in self.schema.names])

    def _between(self, rows: DataFrame, low: Any, high: Any) -> DataFrame:
        first, kind = F.col(quoted(self.keys[0])), self.schema[self.keys[0]].dataType
        if low is not None:
            rows = rows.where(first >= F.lit(low).cast(kind))
        return rows if high is None else rows.where(first <= F.lit(high).cast(kind))

    def _value(self, bound: Any) -> Any:
        if bound is None or not self._measured:
            return None
        one = self.spark.range(1).select(self._measured.of(F.lit(bound).cast(self.schema[self.keys[0]].dataType)))
        return self._measured.decode(one.first()[0])

    def _folded(self, upper: list[Run], touched: list[Run], low: Any, high: Any) -> DataFrame:
        """The last change of every key that changed, and the rows of ``touched`` that did not."""
        changes = self._between(self._open(upper), low, high)
        if not touched:
            return latest_changes(changes, keys=self.keys, order_by=self.order).select(*self._stored().names)
        # Only keys that changed are folded; the others are filtered in place where their keys fit a broadcast.
        base = self._open(touched)
        last = written(latest_changes(changes, keys=self.keys, order_by=self.order), "keyed-changes")
        changed = last.select(*[F.col(quoted(key)).alias(f"__changed_{i}") for i, key in enumerate(self.keys)])
        same = F.lit(True)
        for i, key in enumerate(self.keys):
            same = same & (F.col(quoted(key)) == F.col(f"__changed_{i}"))
        untouched, met = base.join(changed, same, "left_anti"), base.join(changed, same, "left_semi")
        folded = latest_changes(met.unionByName(last), keys=self.keys, order_by=self.order)
        return untouched.unionByName(folded.select(*self._stored().names))
