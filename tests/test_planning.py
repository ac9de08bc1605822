"""Sketched key ranges, the inverted-list index, exact distances, one-pass routing and the payload outbox."""

import datetime
import json

import numpy as np
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from millrace.functions import ivf, vectors
from millrace.operators.sql import QueryError, sql
from millrace.operators.validate import route_each, validate_route
from millrace.plans import sketches
from millrace.session import scratch_dir
from millrace.sinks.files import write_files
from millrace.sinks.outbox import OutboxWriter, Staged
from tests.conftest import rows


def _hits(df, ranges, column, second=None):
    """Rows of each range, after checking that every row is in one."""
    conditions = [F.coalesce(F.expr(c), F.lit(False)).cast("int") for c in sketches.range_conditions(ranges, column, second)]
    totals = df.agg(F.min(sum(conditions)), F.max(sum(conditions)), *[F.sum(c) for c in conditions]).first()
    assert totals[:2] == (1, 1)
    return list(totals[2:])


@pytest.mark.parametrize(
    "key",
    [
        "id * id",
        "cast(id as double) / 7",
        "cast(id as decimal(12,2)) / 3",
        "date_add(date'1960-01-01', cast(id as int))",
        "timestamp_micros(id * 123456789)",
        "concat('Customer#', lpad(cast(id as string), 9, '0'))",
        "concat(repeat('x', cast(id % 3 as int)), 'é', id)",
    ],
)
def test_ranges_of_all_types(spark, key):
    df = spark.range(20_000).select(F.expr(key).alias("k")).union(spark.range(10).select(F.lit(None).alias("k")))
    counts = _hits(df, sketches.sketch_ranges(df, "k", 16), "k")
    assert len(counts) >= 14 and max(counts) < 1.3 * 20_010 / 16


def test_two_passes(spark):
    """More ranges than one sketch cuts."""
    df = spark.range(50_000).select((F.col("id") * 3).alias("k"))
    counts = _hits(df, sketches.sketch_ranges(df, "k", 64, per_sketch=8), "k")
    assert 60 <= len(counts) <= 68 and max(counts) < 1.4 * 50_000 / 64


@pytest.mark.parametrize("key", ["if(id % 3 = 0, 5, id)", "if(id % 3 = 0, 'the same long text', concat('the same long ', id))"])
def test_a_hot_key_is_cut_by_the_second(spark, key):
    df = spark.range(30_000).select(F.expr(key).alias("k"), F.expr("if(id % 100 = 3, null, -id)").alias("s"))
    alone = sketches.sketch_ranges(df, "k", 12)
    assert max(_hits(df, alone, "k")) >= 10_000
    ranges = sketches.sketch_ranges(df, "k", 12, second="s")
    counts = _hits(df, ranges, "k", "s")
    assert max(counts) < 1.5 * 30_000 / 12 and sum(r.of_one_key for r in ranges) >= 3


def test_one_key_and_no_rows(spark):
    one = spark.range(1000).select(F.lit("a").alias("k"), F.col("id").alias("s")).union(spark.range(5).selectExpr("null", "id"))
    assert len(_hits(one, sketches.sketch_ranges(one, "k", 4, second="s"), "k", "s")) == 4
    assert sketches.sketch_ranges(one.limit(0), "k", 4) == [sketches.KeyRange()]
    with pytest.raises(ValueError):
        sketches.sketch_ranges(spark.range(9).selectExpr("array(id) as k"), "k", 4)


def _vectors(spark, matrix, name):
    return spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(matrix)], f"{name} long, vector array<double>")


@pytest.mark.parametrize("metric", ["L2", "IP", "COSINE"])
def test_index(spark, metric):
    """Every vector is in one list; few probes find most neighbours, all probes find the exact ones."""
    rng = np.random.default_rng(3)
    heart = rng.normal(size=(12, 8)) * 10
    matrix = np.vstack([heart[rng.integers(12, size=900)] + rng.normal(size=(900, 8)), np.zeros((300, 8))])  # one hot list
    corpus, queries = _vectors(spark, matrix, "vec_id"), _vectors(spark, matrix[:40] + 0.01, "query_id")
    index = ivf.build_index(corpus, scratch_dir(spark, "ivf"), lists=12, metric=metric, rows_per_file=100)
    listed = index.lists(spark)
    assert sorted(r.vec_id for r in listed.select("vec_id").collect()) == list(range(1200))
    exact = {(r.query_id, r.vec_id): r.distance for r in vectors.vector_topk(queries, corpus, metric=metric, k=10).collect()}
    opened = ivf.IvfIndex.open(spark, index.path)
    some = {(r.query_id, r.vec_id): r.distance for r in ivf.search(spark, opened, queries, k=10, probes=4).collect()}
    assert len(exact.keys() & some.keys()) >= 0.9 * len(exact)
    every = ivf.search(spark, opened, queries, k=10, probes=12, block_rows=64)
    assert {(r.query_id, r.vec_id): r.distance for r in every.collect()} == exact
    assert "CartesianProduct" not in every._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in every._jdf.queryExecution().executedPlan().toString()


def test_index_of_nothing_and_of_nulls(spark):
    none = spark.createDataFrame([(1, None)], "vec_id long, vector array<double>")
    index = ivf.build_index(none, scratch_dir(spark, "ivf"), lists=4)
    asked = spark.createDataFrame([(1, [1.0, 2.0])], "query_id long, vector array<double>")
    assert index.lists(spark).count() == 0 and ivf.search(spark, index, asked).count() == 0


def test_exact_distances(spark):
    base = np.full((1, 16), 1e8)
    corpus = _vectors(spark, base + np.arange(50)[:, None] * 0.5, "vec_id")
    queries = _vectors(spark, base, "query_id")
    found = vectors.vector_topk(queries, corpus, k=3).orderBy("rank").collect()
    assert [(r.vec_id, r.distance) for r in found] == [(0, 0.0), (1, 2.0), (2, 4.0)]
    with pytest.raises(ValueError):
        vectors.vector_topk(queries.union(queries), corpus)
    broken = spark.createDataFrame([(1, [1.0, None])], "query_id long, vector array<double>")
    with pytest.raises(Exception):
        vectors.vector_topk(broken, corpus).collect()


def test_routing_reads_the_input_once(spark):
    source = scratch_dir(spark, "source")
    spark.range(100).selectExpr("id", "cast(null as string) as v").write.parquet(source)
    df = spark.read.parquet(source)
    options = {"field_rules": [{"field_name": "id", "rule_type": "RANGE", "min_value": 10}], "table": "db.t"}
    routed = validate_route(df, read_once=True, **options)
    for part, many in ((routed.valid, 90), (routed.errors, 10)):
        assert part.count() == many and not [f for f in part.inputFiles() if source in f]
    assert routed.valid.columns == ["id", "v"] and rows(routed.errors.select("original_data"))[0] == ('{"id":0,"v":null}',)
    twice = validate_route(df, **options)
    assert rows(twice.errors.drop("create_time")) == rows(routed.errors.drop("create_time"))
    seen = []
    handle = route_each(lambda good, n: seen.append((n, good.count())), lambda bad, n: seen.append((n, bad.count())), **options)
    handle(df, 7)
    assert seen == [(7, 90), (7, 10)]


def test_outbox_epochs(tmp_path):
    """Killed before, inside and after the commit of an epoch: each payload arrives once."""
    writer = OutboxWriter(str(tmp_path), 0)
    staged = lambda *bodies: writer.write(iter([(b,) for b in bodies]))
    sent = lambda: sorted(line for f in (tmp_path / "sent").rglob("*.jsonl") for line in f.read_text().splitlines())
    assert writer.write(iter([])) == Staged(None)
    writer.commit([staged("a", "b"), Staged(None), staged("c")], 0)
    writer.commit([staged("a", "b"), staged("c")], 0)  # the epoch comes again
    assert sent() == ["a", "b", "c"]
    # Killed after one of two files was moved.
    first, second = staged("d"), staged("e")
    (tmp_path / "ledger" / "1.prepared").write_text(json.dumps([first.file, second.file]))
    (tmp_path / "sent" / "epoch=1").mkdir()
    pafs.LocalFileSystem().move(str(tmp_path / first.file), str(tmp_path / "sent" / "epoch=1" / "part-00000.jsonl"))
    writer.commit([staged("d", "e")], 1)
    assert sent() == ["a", "b", "c", "d", "e"]
    lost = staged("x")
    writer.abort([lost, None], 2)
    assert not list((tmp_path / "staging").iterdir())


def test_carriage_returns_are_refused(spark):
    for bad in ("x\ry", "x\ny"):
        df = spark.createDataFrame([(bad,)], "v string")
        with pytest.raises(Exception, match="delimiter"):
            write_files(df, scratch_dir(spark, "text"), fmt="text")


def test_comments_before_a_query(spark):
    df = spark.createDataFrame([(1, "+I")], "id long, __kind string")
    for comment in ("/* select all */", "-- select\n", "/* a /* select */ b */ -- c\n\t"):
        assert sql(df, f"{comment} SELECT id FROM dual", carry_envelope=True).columns == ["id", "__kind"]
    with pytest.raises(QueryError):
        sql(df, "FROM dual SELECT id", carry_envelope=True)


def test_dates_are_measured_in_order():
    import pyspark.sql.types as T

    measure = sketches._measure(T.StringType(), "ab1", "abzz")
    assert measure.key((ord("1") << 42) | (ord("2") << 21)) == "ab12"
    assert sketches._measure(T.DateType(), None, None).key(-1) == datetime.date(1969, 12, 31)
