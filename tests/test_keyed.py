"""The keyed table's levels: ranges, merges that leave the rest alone, commits, retention, and rows against a dictionary."""

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from millrace.envelope import KIND, SEQ
from millrace.session import list_paths, scratch_dir
from millrace import storage
from millrace.sinks import keyed
from millrace.sinks.keyed import KeyedTable, Run, overlapping
from millrace.storage import exists, read_text, remove, write_text
from tests.conftest import rows

STATE = T.StructType().add("id", "long").add("v", "string")
LOG = T.StructType([*STATE.fields, T.StructField(KIND, T.StringType()), T.StructField(SEQ, T.LongType())])


def _table(spark, path=None, **settings):
    return KeyedTable(spark, path or scratch_dir(spark, "keyed"), keys=["id"], schema=STATE, **settings)


def _log(spark, *changes):
    return spark.createDataFrame(list(changes), LOG).coalesce(1)


def _files(table):
    return {run.path for level in table.manifest().levels for run in level}


def test_any_order_of_batches_gives_the_dictionary(spark):
    """Small pieces and a small fan, so that merges reach several levels; late changes, deletes and replays among them."""
    rng, model, seq = random.Random(7), {}, {}
    table = _table(spark, fan=2, piece_bytes=1500, retention_seconds=0)
    first = [(i, f"s{i}") for i in range(0, 400, 2)]
    table.load(spark.createDataFrame(first, STATE))
    model.update(first)
    for batch in range(8):
        changes = []
        start = rng.randrange(400)
        for at in rng.sample(range(1000), 25):
            key = (start + rng.randrange(60)) % 400
            kind = rng.choice(["+U", "+U", "-D"])
            changes.append((key, f"b{batch}-{at}", kind, at * 100 + batch))
            if changes[-1][3] > seq.get(key, -1):
                seq[key] = changes[-1][3]
                model.pop(key, None)
                if kind == "+U":
                    model[key] = changes[-1][1]
        table.apply(_log(spark, *changes), batch)
        if batch % 4 == 3:
            table.apply(_log(spark, (0, "replayed", "+U", 10**9)), batch - 1)
            assert rows(table.read()) == sorted(model.items(), key=repr)
    levels = table.manifest().levels
    assert len(levels) > 2 and sum(len(runs) for runs in levels[1:]) > 3
    for runs in levels[1:]:
        ranges = sorted((run.low, run.high) for run in runs)
        assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    for low, high in ((50, 90), (395, None)):
        want = {k: v for k, v in model.items() if (low is None or k >= low) and (high is None or k <= high)}
        assert rows(table.read(low, high)) == sorted(want.items(), key=repr)
    table.compact()
    assert rows(table.read()) == sorted(model.items(), key=repr)
    assert sum(1 for runs in table.manifest().levels if runs) == 1


def test_merges_and_reads_open_only_what_overlaps(spark):
    table = _table(spark, piece_bytes=2_000, retention_seconds=3600)
    table.load(spark.range(0, 2000).select("id", F.concat(F.lit("v"), "id").alias("v")))
    before = {run.path: run for run in table.manifest().levels[-1]}
    assert len(before) > 5
    hit = next(run for run in before.values() if run.low <= 700 <= run.high)
    table.apply(_log(spark, (700, "new", "+U", 1)), 0)
    opened = {f.split("/runs/")[1] for f in table.read(690, 710).inputFiles() if "/runs/" in f}
    assert {f"runs/{f}" for f in opened} <= {hit.path, *before} and len(opened) <= 2
    plan = table.read()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") <= 3
    table.compact()
    after = _files(table)
    assert set(before) - {hit.path} < after and hit.path not in after
    assert table.read(700, 700).first().v == "new" and table.read().count() == 2000
    # What was replaced is still there for those who read it, until its time is over.
    assert exists(spark, f"{table.path}/{hit.path}")
    late = _table(spark, table.path, retention_seconds=0)
    late.apply(_log(spark, (1, "x", "+U", 2)), 1)
    assert not exists(spark, f"{table.path}/{hit.path}")


def test_batches_list_no_folder(spark, monkeypatch):
    table = _table(spark, fan=4, retention_seconds=0)
    table.apply(_log(spark, (0, "v", "+U", 0)), 0)

    def listed(*_):
        raise AssertionError("a folder is listed")

    for module in (keyed, storage):
        monkeypatch.setattr(module, "list_paths", listed)
    for batch in range(1, 14):
        table.apply(_log(spark, (batch % 5, f"v{batch}", "+U", batch)), batch)
    assert rows(table.read()) == [(k, f"v{max(b for b in range(14) if b % 5 == k)}") for k in range(5)]
    monkeypatch.undo()
    # Replaced folders and old manifests are gone: what is left does not grow with the number of batches.
    assert len(list_paths(spark, f"{table.path}/runs/*")) <= 4 + 1 + 4
    assert len(list_paths(spark, f"{table.path}/manifest/*.json")) <= 17
    assert len(list_paths(spark, f"{table.path}/manifest/*.list")) <= 3


def test_a_broken_commit_leaves_the_table_as_it_was(spark, monkeypatch):
    table = _table(spark, fan=2, retention_seconds=0)
    table.apply(_log(spark, (1, "a", "+U", 1)), 0)
    with monkeypatch.context() as patched:
        patched.setattr(KeyedTable, "_commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.apply(_log(spark, (1, "lost", "+U", 5)), 1)
    assert rows(table.read()) == [(1, "a")]
    table.apply(_log(spark, (1, "b", "+U", 5)), 1)
    assert rows(table.read()) == [(1, "b")]
    named = {path.split("/")[1] for path in _files(table) | {path for path, _ in table.manifest().replaced}}
    there = lambda: {path.rsplit("/", 1)[1] for path in list_paths(spark, f"{table.path}/runs/*")}
    assert len(there() - named) == 1
    table.vacuum()
    assert there() <= named and {path.split("/")[1] for path in _files(table)} <= there()
    assert rows(table.read()) == [(1, "b")]


def test_the_pointer_may_lag_or_be_lost(spark):
    table = _table(spark)
    for batch in range(3):
        table.apply(_log(spark, (1, f"v{batch}", "+U", batch)), batch)
    current, newest = f"{table.path}/manifest/current", table.manifest().version
    write_text(spark, current, str(newest - 1), replace=True)
    assert table.manifest().version == newest
    remove(spark, current)
    assert table.manifest().version == newest and read_text(spark, current) is None
    assert rows(_table(spark, table.path).read()) == [(1, "v2")]


@pytest.mark.parametrize(
    "kind, values",
    [
        ("string", ["", "B", "a", "é", "zz"]),
        ("decimal(10,2)", [Decimal("-3.50"), Decimal("9.00"), Decimal("10.00"), Decimal("100.25")]),
        ("date", [datetime.date(1969, 1, 1), datetime.date(2024, 2, 29), datetime.date(2030, 1, 1)]),
        ("timestamp", [datetime.datetime(1960, 1, 1), datetime.datetime(2024, 1, 1, 0, 0, 0, 5)]),
        ("binary", [b"", b"\x00", b"\xff\x01"]),
    ],
)
def test_key_types(spark, kind, values):
    schema = T.StructType.fromDDL(f"k {kind}, v int")
    table = KeyedTable(spark, scratch_dir(spark, "keyed"), keys=["k"], schema=schema, fan=2, piece_bytes=1)
    table.load(spark.createDataFrame([(k, 0) for k in values], schema))
    log = T.StructType([*schema.fields, T.StructField(KIND, T.StringType()), T.StructField(SEQ, T.LongType())])
    for batch, key in enumerate(values):
        if batch < 2:
            table.apply(spark.createDataFrame([(key, batch + 1, "+U", batch)], log), batch)
    as_read = lambda k: bytearray(k) if isinstance(k, bytes) else k
    assert sorted(table.read().collect()) == sorted((as_read(k), i + 1 if i < 2 else 0) for i, k in enumerate(values))
    assert table.read(values[1], values[1]).count() == 1


def test_overlapping_runs():
    run = lambda name, low, high: Run(name, low, high, 1, 1)
    runs = [run("a", 0, 5), run("b", 6, 9), run("c", 20, 30), run("open", None, None)]
    assert [r.path for r in overlapping(runs, [run("x", 9, 12), run("y", 30, 40)])] == ["b", "c", "open"]
    assert [r.path for r in overlapping(runs, [run("x", 10, 19)])] == ["open"]
    assert overlapping(runs, []) == [] and overlapping(runs, [run("z", None, None)]) == runs


def test_a_task_takes_so_many_rows_however_well_they_pack(spark, monkeypatch):
    """Rows that take few bytes in a file are cut by what they take in memory, in the snapshot and in merges."""
    monkeypatch.setattr(keyed, "_TASK_BYTES", 10_000)
    table = _table(spark, fan=2)
    table.load(spark.range(1000).select("id", F.lit("same").alias("v")))
    assert len(_files(table)) > 5
    for batch in range(2):
        table.apply(spark.range(1000).select("id", F.lit("new").alias("v"), F.lit("+U").alias(KIND), F.lit(batch).cast("long").alias(SEQ)), batch)
    assert len(_files(table)) > 5 and table.read().where("v = 'new'").count() == 1000


def test_a_batch_too_large_for_the_upper_levels_is_merged_once(spark, monkeypatch):
    table, merged = _table(spark, fan=2, piece_bytes=500), []
    table.load(spark.range(2000).select("id", F.lit("old").alias("v")))
    pieces = KeyedTable._pieces
    monkeypatch.setattr(KeyedTable, "_pieces", lambda self, *given: merged.append(1) or pieces(self, *given))
    for batch in range(2):
        table.apply(spark.range(0, 2000, 2).select("id", F.lit("new").alias("v"), F.lit("+U").alias(KIND), F.lit(batch).cast("long").alias(SEQ)), batch)
    assert len(merged) <= 2
    assert {r.v: r["count"] for r in table.read().groupBy("v").count().collect()} == {"new": 1000, "old": 1000}
