"""The stream that reads a snapshot and goes over to the changes: bounds, rates, kills in and between the phases."""

import pytest
from pyspark.sql import Row, functions as F, types as T

from millrace.envelope import EVENT_MS, KIND, SEQ
from millrace.session import scratch_dir
from millrace.streaming.fold import STATE_SETTINGS, stream_fold
from millrace.streaming.handover import drain, scan_snapshot_then_changes
from millrace.streaming.scan import scan_stream
from millrace.streaming.sinks import run_to_end
from millrace.operators.changelog import fold_changelog
from tests.conftest import rows

ROW = T.StructType().add("id", "long").add("v", "string").add("t", "timestamp").add("d", "decimal(20,3)")


@pytest.fixture(scope="module")
def folders(spark):
    """100 rows in three files; 60 changes in three files with positions 1 to 60, those of ten together on one."""
    snapshot, changes = scratch_dir(spark, "snapshot"), scratch_dir(spark, "changes")
    body = [F.concat(F.lit("v"), "id").alias("v"), F.expr("timestamp_seconds(id) as t"), F.expr("cast(id as decimal(20,3)) / 8 as d")]
    spark.range(100).select("id", *body).repartition(3, "id").write.parquet(snapshot)
    log = spark.range(1, 61).select(
        (F.col("id") % 20).alias("id"),
        *body,
        F.expr("if(id % 7 = 0, '-D', '+U')").alias(KIND),
        F.expr("if(id > 50, 51, id)").alias(SEQ),
        (F.col("id") * 1000).alias(EVENT_MS),
    )
    for low in (1, 21, 41):
        log.where(F.col(EVENT_MS).between(low * 1000, (low + 19) * 1000)).coalesce(1).write.mode("append").parquet(changes)
    return snapshot, changes


def collected(spark, stream, checkpoint=None):
    """The rows of each micro-batch."""
    batches = []
    writer = stream.writeStream.foreachBatch(lambda df, _: batches.append(df.collect()))
    drain(writer, checkpoint or scratch_dir(spark, "checkpoint"))
    return batches


def positions(batches):
    return sorted(row[SEQ] for batch in batches for row in batch)


def test_both_phases(spark, folders):
    batches = collected(spark, scan_snapshot_then_changes(spark, *folders, schema=ROW))
    assert [len(b) for b in batches] == [100, 60]
    assert {(r[KIND], r[SEQ], r[EVENT_MS]) for r in batches[0]} == {("+I", 0, None)}
    first = next(r for r in batches[0] if r.id == 17)
    assert (first.v, first.t.timestamp() % 60, str(first.d)) == ("v17", 17.0, "2.125")
    assert positions(batches[1:]) == [*range(1, 51), *[51] * 10]


@pytest.mark.parametrize(
    "start, want",
    [
        ({"start_mode": "earliest"}, [*range(1, 51), *[51] * 10]),
        ({"start_mode": "specific", "position": 48}, [49, 50, *[51] * 10]),
        ({"start_mode": "latest"}, []),
        ({"start_mode": "timestamp", "timestamp_ms": 49_000}, [49, 50, *[51] * 10]),
        ({"start_mode": "earliest", "stop_mode": "specific", "stop_position": 3}, [1, 2, 3]),
        ({"start_mode": "earliest", "stop_mode": "timestamp", "stop_timestamp_ms": 3_000}, [1, 2]),
        ({"start_mode": "initial", "position": 50, "stop_mode": "latest"}, [*[0] * 100, *[51] * 10]),
    ],
)
def test_bounds(spark, folders, start, want):
    assert positions(collected(spark, scan_snapshot_then_changes(spark, *folders, schema=ROW, **start))) == want


def test_rate(spark, folders):
    """No batch is above the stated rows, but for a position that more changes share: it is not cut."""
    batches = collected(spark, scan_snapshot_then_changes(spark, *folders, schema=ROW, rows_per_batch=7))
    assert positions(batches) == [*[0] * 100, *range(1, 51), *[51] * 10]
    sizes = [len(b) for b in batches]
    assert sizes[-1] == 10 and max(sizes[:-1]) == 7 and len(sizes) == 15 + 8 + 1
    assert len({r.id for b in batches[:15] for r in b}) == 100


@pytest.mark.parametrize("broken", [0, 4, 15, 17])
def test_a_killed_stream_goes_on_where_it_stood(spark, folders, broken):
    """Killed at the first batch, inside the snapshot, at the first batch of changes and after it."""
    checkpoint, done = scratch_dir(spark, "checkpoint"), {}

    def take(df, batch):
        found = [tuple(r) for r in df.collect()]
        if batch == broken and "killed" not in done:
            done["killed"] = found
            raise RuntimeError("killed")
        done[batch] = found

    def run():
        stream = scan_snapshot_then_changes(spark, *folders, schema=ROW, rows_per_batch=7)
        drain(stream.writeStream.foreachBatch(take), checkpoint)

    with pytest.raises(Exception):
        run()
    run()
    assert sorted(done.pop("killed"), key=repr) == sorted(done[broken], key=repr)
    assert sorted(r[-2] for found in done.values() for r in found) == [*[0] * 100, *range(1, 51), *[51] * 10]


def test_new_changes_are_read_by_the_next_run(spark, folders):
    changes, checkpoint = scratch_dir(spark, "changes"), scratch_dir(spark, "checkpoint")
    log = spark.read.parquet(folders[1])
    seen = []
    for low, high in ((0, 20), (20, 30), (30, 99)):
        log.where(F.col(SEQ).between(low + 1, high)).coalesce(1).write.mode("append").parquet(changes)
        stream = scan_snapshot_then_changes(spark, folders[0], changes, schema=ROW)
        seen.append(positions(collected(spark, stream, checkpoint)))
    assert seen == [[*[0] * 100, *range(1, 21)], [*range(21, 31)], [*range(31, 51), *[51] * 10]]


def test_wrong_options(spark):
    for wrong in ({"start_mode": "sometime"}, {"start_mode": "specific"}, {"stop_mode": "timestamp"}, {"rows_per_batch": 0}):
        with pytest.raises(ValueError):
            scan_snapshot_then_changes(spark, "a", "b", schema=ROW, **wrong)
    with pytest.raises(ValueError):
        scan_snapshot_then_changes(spark, None, "b", schema=ROW)


LOG = T.StructType().add("id", "long").add("v", "string").add(KIND, "string").add(SEQ, "long")


def _folded(spark, batches, ttl=7 * 86_400_000):
    """What a stream of these batches, one run each, puts out."""
    source, out, checkpoint = (scratch_dir(spark, x) for x in ("in", "out", "cp"))
    for batch in batches:
        spark.createDataFrame(batch, LOG).coalesce(1).write.mode("append").parquet(source)
        run_to_end(stream_fold(scan_stream(spark, source, schema=LOG), out, checkpoint, keys=["id"], deleted_ttl_ms=ttl))
    return spark.read.schema(LOG).parquet(out)


def test_fold_in_the_stream(spark):
    """Restarts after every batch; a late change, a change after its delete, a delete of nothing, a null payload."""
    batches = [
        [(1, "a", "+I", 10), (2, "b", "+I", 11), (1, "a", "-U", 12), (1, "a2", "+U", 12), (3, None, "+I", 1)],
        [(1, "late", "+U", 5), (2, "b", "-D", 20), (4, "x", "-D", 3)],
        [(2, "older", "+U", 15), (4, "y", "+I", 9), (3, "c", "+U", None), (1, "a3", "+U", 30), (1, "a2", "-D", 29)],
    ]
    out = _folded(spark, batches)
    assert rows(out) == sorted(
        [
            (1, "a2", "+I", 12), (2, "b", "+I", 11), (3, None, "+I", 1), (2, "b", "-D", 20), (4, "y", "+I", 9), (1, "a3", "+U", 30),
        ],
        key=repr,
    )
    assert [spark.conf.get(key, None) for key in STATE_SETTINGS][1] != "false"
    every = spark.createDataFrame([row for batch in batches for row in batch], LOG)
    assert rows(fold_changelog(out, keys=["id"])) == rows(fold_changelog(every, keys=["id"]))


def test_deleted_keys_are_forgotten(spark):
    import time

    source, out, checkpoint = (scratch_dir(spark, x) for x in ("in", "out", "cp"))
    for batch, wait in (([(1, "a", "+I", 1), (1, "a", "-D", 5)], 1.5), ([(1, "late", "+U", 3)], 0)):
        spark.createDataFrame(batch, LOG).coalesce(1).write.mode("append").parquet(source)
        run_to_end(stream_fold(scan_stream(spark, source, schema=LOG), out, checkpoint, keys=["id"], deleted_ttl_ms=1000))
        time.sleep(wait)
    assert rows(spark.read.schema(LOG).parquet(out)) == [(1, "late", "+I", 3)]
    assert _folded(spark, [[(1, "a", "+I", 1), (1, "a", "-D", 5)], [(1, "late", "+U", 3)]], ttl=None).count() == 0


def test_a_change_without_a_kind_is_an_error(spark):
    with pytest.raises(Exception):
        _folded(spark, [[(1, "a", None, 1)]])


def test_fold_reads_state_once_for_many_keys():
    """The state is called a few times for a bucket, however many keys it has."""
    from types import SimpleNamespace

    from millrace.streaming import fold

    calls = []

    class Value:
        held = None

        def get(self):
            calls.append("get")
            return self.held

        def update(self, held):
            calls.append("update")
            self.held = held

        def clear(self):
            calls.append("clear")
            self.held = None

    processor = fold.FoldChanges(["id"], 1000)
    processor.init(SimpleNamespace(getValueState=lambda name, schema, ttl=None: Value()))
    row = Row("id", KIND, SEQ, "__place", "__rank", "__id")

    def batch(kind, place, ids, now):
        timer = SimpleNamespace(getCurrentProcessingTimeInMs=lambda: now)
        changes = iter([row(i, kind, place, place, 1 if kind == "-D" else 3, None if i is None else str(i)) for i in ids])
        return sorted((tuple(r) for r in processor.handleInputRows(("b",), changes, timer)), key=repr)

    ids = [*range(500), None]
    assert {r[1] for r in batch("+U", 5, ids, 0)} == {"+I"}
    assert {r[1] for r in batch("-D", 7, ids, 10)} == {"-D"}
    assert batch("+U", 6, ids, 900) == []
    assert batch("+U", 6, [None, 3], 1010) == [(3, "+I", 6), (None, "+I", 6)]
    assert len(calls) <= 16


def test_fold_with_keys_of_several_types(spark):
    """Keys are told apart by all their values, in one bucket or many."""
    source, out, checkpoint = (scratch_dir(spark, x) for x in ("in", "out", "cp"))
    schema = "a string, b double, t timestamp, v string, __kind string, __seq bigint"
    first = """VALUES ('x', 0.0D, timestamp'2024-01-01 00:00:00.000001', 'p', '+I', 1L), ('x', 1.0D, timestamp'2024-01-01', 'q', '+I', 1L),
               ('x","1', 1.0D, timestamp'2024-01-01', 'r', '+I', 1L), ('x', 0.0D, timestamp'2024-01-01 00:00:00.000002', 's', '+I', 1L)"""
    then = "VALUES ('x', -0.0D, timestamp'2024-01-01 00:00:00.000001', 'p2', '+U', 2L), ('x', 1.0D, timestamp'2024-01-01', 'q', '-D', 2L)"
    for batch in (first, then):
        spark.sql(batch).toDF("a", "b", "t", "v", KIND, SEQ).coalesce(1).write.mode("append").parquet(source)
        stream = scan_stream(spark, source, schema=T._parse_datatype_string(schema))
        run_to_end(stream_fold(stream, out, checkpoint, keys=["a", "b", "t"]))
    found = spark.read.schema(schema).parquet(out).select("v", KIND)
    assert rows(found) == [("p", "+I"), ("p2", "+U"), ("q", "+I"), ("q", "-D"), ("r", "+I"), ("s", "+I")]
