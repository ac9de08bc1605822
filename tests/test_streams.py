import pytest
from pyspark.sql import types as T

from millrace.envelope import KIND, SEQ
from millrace.operators import evolve as e
from millrace.session import scratch_dir
from millrace.sinks.keyed import KeyedTable
from millrace.streaming.evolution import EvolvingTable, event_message, parse_event
from millrace.streaming.metrics import count_streams, stream_counts
from millrace.streaming.scan import rate_limit_options, scan_stream, topic_options
from millrace.streaming.sinks import run_to_end, stream_apply_changelog, stream_to_files
from tests.conftest import rows

LOG = T.StructType().add(KIND, "string").add("id", "long").add("v", "string").add(SEQ, "long")
STATE = T.StructType().add("id", "long").add("v", "string")


def _log(spark, *changes):
    return spark.createDataFrame(list(changes), LOG)


def test_restart_adds_nothing(spark):
    source, out, checkpoint = (scratch_dir(spark, x) for x in ("in", "out", "cp"))
    spark.range(10).write.parquet(source)

    def run():
        return run_to_end(stream_to_files(scan_stream(spark, source, schema=spark.range(1).schema), out, checkpoint))

    totals = count_streams(spark)
    first = run()
    assert stream_counts(first, totals)["source_received"] == 10
    spark.streams.removeListener(totals)
    run()
    assert spark.read.parquet(out).count() == 10
    spark.range(10, 15).write.mode("append").parquet(source)
    run()
    assert spark.read.parquet(out).count() == 15


def test_keyed_table_replay_order_and_compaction(spark):
    table = KeyedTable(spark, scratch_dir(spark, "keyed"), keys=["id"], schema=STATE)
    assert rows(table.read()) == []
    table.load(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], STATE))
    table.apply(_log(spark, ("+U", 1, "a1", 1), ("-D", 2, "b", 2), ("+I", 4, "d", 3)), 0)
    want = [(1, "a1"), (3, "c"), (4, "d")]
    assert rows(table.read()) == want
    # A replay of a finished batch changes nothing, even if it would now say something else.
    table.apply(_log(spark, ("-D", 1, "a1", 1)), 0)
    assert rows(table.read()) == want
    # A change that arrives late does not replace a newer one, nor bring back what was deleted after it.
    table.apply(_log(spark, ("+I", 2, "late", 1), ("+U", 1, "late", 0)), 1)
    assert rows(table.read()) == want
    arrival = KeyedTable(spark, table.path, keys=["id"], schema=STATE, arrival_order=True)
    assert rows(arrival.read()) == [(1, "late"), (2, "late"), (3, "c"), (4, "d")]
    table.apply(_log(spark, ("+I", 2, "again", 7), ("+U", 1, "a2", 8)), 2)
    want = [(1, "a2"), (2, "again"), (3, "c"), (4, "d")]
    assert rows(table.read()) == want
    table.compact()
    table.compact()
    assert rows(table.read()) == want and [len(level) for level in table.manifest().levels] == [0, 1]
    table.apply(_log(spark, ("-D", 4, "d", 9), ("+U", 1, "older", 2)), 3)
    assert rows(table.read()) == want[:3]
    # A snapshot that is passed again changes nothing; another stream is refused.
    table.load(spark.createDataFrame([(1, "first")], STATE))
    assert rows(table.read()) == want[:3]
    table.belongs_to("one")
    table.belongs_to("one")
    with pytest.raises(ValueError):
        table.belongs_to("other")


def test_half_written_batch_is_not_seen(spark):
    table = KeyedTable(spark, scratch_dir(spark, "keyed"), keys=["id"], schema=STATE)
    table.load(spark.createDataFrame([(1, "a")], STATE))
    stray = _log(spark, ("+U", 1, "zzz", 5)).select("id", "v", KIND, SEQ)
    stray.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{table.path}/delta=0")
    assert rows(table.read()) == [(1, "a")]
    table.apply(_log(spark, ("+U", 1, "b", 6)), 0)
    assert rows(table.read()) == [(1, "b")]


def test_stream_into_keyed_table(spark):
    source, checkpoint = scratch_dir(spark, "in"), scratch_dir(spark, "cp")
    table = KeyedTable(spark, scratch_dir(spark, "keyed"), keys=["id"], schema=STATE)
    for i, change in enumerate([("+I", 1, "a", 1), ("+U", 1, "b", 2), ("-D", 1, "b", 3), ("+I", 1, "c", 4)]):
        _log(spark, change).write.mode("append").parquet(source)
        run_to_end(stream_apply_changelog(scan_stream(spark, source, schema=LOG), table, checkpoint, compact_every=2))
        want = {0: [(1, "a")], 1: [(1, "b")], 2: [], 3: [(1, "c")]}[i]
        assert rows(table.read()) == want


def test_events_survive_as_messages():
    for event in (e.AddColumn("x", "int", default=3), e.DropColumn("x"), e.ModifyColumn("x", "bigint"), e.RenameColumn("x", "y")):
        assert parse_event(event_message(event)) == event


def test_schema_change_inside_a_batch(spark):
    table = EvolvingTable(spark, scratch_dir(spark, "evolving"), T.StructType().add("id", "integer").add("v", "string"))

    def batch(*messages):
        return spark.createDataFrame(list(messages), f"value string, `{SEQ}` bigint")

    assert table.read().count() == 0
    first = batch(
        ('{"id":1,"v":"a"}', 1),
        (event_message(e.AddColumn("w", "int", default=7)), 2),
        ('{"id":2,"v":"b","w":1}', 3),
        (event_message(e.RenameColumn("v", "name")), 4),
        ('{"id":3,"name":"c","w":2}', 5),
    )
    table.apply(first, 0)
    table.apply(first, 0)  # replay
    assert rows(table.read().select("id", "name", "w")) == [(1, "a", 7), (2, "b", 1), (3, "c", 2)]
    table.apply(batch((event_message(e.DropColumn("w")), 6), ('{"id":4,"name":"d"}', 7)), 1)
    assert table.read().columns == ["id", "name", SEQ]
    assert rows(table.read().select("id", "name")) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]


def test_rows_find_their_schema_version(spark):
    """A row with an event's own number comes before it, a late row is read as of its place, a broken one raises."""
    table = EvolvingTable(spark, scratch_dir(spark, "evolving"), T.StructType().add("id", "integer").add("v", "string"))

    def batch(*messages):
        return spark.createDataFrame(list(messages), f"value string, `{SEQ}` bigint")

    table.apply(batch(('{"id":1,"v":"a"}', 5), (event_message(e.RenameColumn("v", "name")), 5), ('{"id":2,"name":"b"}', 6)), 0)
    table.apply(batch(('{"id":3,"v":"late"}', 2), ('{"id":4,"name":"d"}', 9)), 1)
    assert rows(table.read().select("id", "name")) == [(1, "a"), (2, "b"), (3, "late"), (4, "d")]
    for broken in ('{"id":"x","name":"y"}', "not json", "[1]"):
        with pytest.raises(Exception):
            table.apply(batch((broken, 10)), 2)
    assert table.read().count() == 4


def test_totals_of_a_long_stream(spark):
    """Spark keeps a hundred progress reports; the totals cover all of them."""
    source = scratch_dir(spark, "in")
    spark.range(0, 104, 1, 104).write.parquet(source)
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(source)
    totals = count_streams(spark)
    query = run_to_end(stream.writeStream.format("noop").option("checkpointLocation", scratch_dir(spark, "cp")).trigger(availableNow=True).start())
    counts = stream_counts(query, totals)
    spark.streams.removeListener(totals)
    assert counts["source_received"] == 104 and counts["batches"] >= 104


def test_stream_bounds(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    with pytest.raises(ValueError):
        scan_stream(spark, sf_dir, schema=schema, start_mode="TIMESTAMP")
    with pytest.raises(ValueError):
        scan_stream(spark, sf_dir, schema=schema, start_mode="SOMETIME")
    stream = scan_stream(spark, sf_dir, schema=schema, file_glob="events.parquet", event_time="ts", stop_mode="TIMESTAMP", stop_timestamp="2024-01-02")
    assert stream.isStreaming


def test_topic_options():
    assert topic_options("h:1", "t", start_mode="EARLIEST", rows_per_second=100, trigger_seconds=2) == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "200",
    }
    bounded = topic_options("h:1", "t.*", pattern=True, start_mode="TIMESTAMP", start_timestamp_ms=5, stop_mode="TIMESTAMP", stop_timestamp_ms=9)
    assert bounded["subscribePattern"] == "t.*" and bounded["startingTimestamp"] == "5" and bounded["endingTimestamp"] == "9"
    with pytest.raises(ValueError):
        topic_options("h:1", "t", stop_mode="TIMESTAMP")
    assert rate_limit_options("files", bytes_per_second=10) == {"maxBytesPerTrigger": "10"}
    with pytest.raises(ValueError):
        rate_limit_options("files", rows_per_second=10)


def test_evolving_table_keeps_numbers_and_compacts(spark):
    """A name that is dropped and added again is another column; types on the way count; batches are one path a version."""
    table = EvolvingTable(spark, scratch_dir(spark, "evolving"), T.StructType().add("id", "integer").add("v", "integer"))

    def batch(*messages):
        return spark.createDataFrame(list(messages), f"value string, `{SEQ}` bigint")

    steps = [
        ('{"id":1,"v":5}', 1),
        (event_message(e.ModifyColumn("v", "bigint")), 2),
        ('{"id":2,"v":6}', 3),
        (event_message(e.DropColumn("v")), 4),
        (event_message(e.AddColumn("v", "string", default="new", first=True)), 5),
        ('{"id":3,"v":"x"}', 6),
        (event_message(e.RenameColumn("id", "key")), 7),
    ]
    for i, step in enumerate(steps):
        table.apply(batch(step), i)
    want = [("new", 1), ("new", 2), ("x", 3)]
    assert table.read().columns == ["v", "key", SEQ] and rows(table.read().select("v", "key")) == want
    for i in range(len(steps), len(steps) + 3):
        table.apply(batch((f'{{"key":{i},"v":null}}', 100 + i)), i)
    want = sorted([*want, *[(None, i) for i in range(7, 10)]], key=repr)
    # Half of a batch that was not finished is not read, and written anew when it comes again.
    spark.createDataFrame([("lost", 99, 999)], f"c2 string, c0 int, `{SEQ}` bigint").write.parquet(f"{table.path}/rows/version=4/batch=10")
    assert rows(table.read().select("v", "key")) == want
    plan = table.read()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 5
    for _ in range(2):
        table.compact()
        assert rows(table.read().select("v", "key")) == want
    table.apply(batch((event_message(e.ModifyColumn("key", "bigint")), 200), ('{"key":20,"v":"late"}', 201)), 10)
    assert rows(table.read().select("v", "key")) == sorted([*want, ("late", 20)], key=repr)
    assert table.read().schema["key"].dataType == T.LongType()
