import json
import random

import pytest
from pyspark.sql import functions as F, types as T

from millrace.envelope import EVENT_MS, KIND, SEQ, TABLE, TableSet
from millrace.operators import changelog as c, evolve as e, messages as m
from millrace.session import scratch_dir
from tests.conftest import plan_of, rows

PRODUCT = {"id": "int", "name": "string", "weight": "double"}
SCHEMA = f"`{KIND}` string, id bigint, name string, score int, `{SEQ}` bigint"
CHANGES = [
    ("+I", 1, "A", 100, 0), ("+I", 2, "B", 100, 1), ("+I", 3, "C", 100, 2),
    ("-U", 1, "A", 100, 3), ("+U", 1, "A_1", 100, 3), ("-D", 2, "B", 100, 4),
]


def messages(spark, *bodies):
    texts = [b if isinstance(b, str) or b is None else json.dumps(b) for b in bodies]
    return spark.createDataFrame([(t, i) for i, t in enumerate(texts)], f"value string, `{SEQ}` bigint")


def shown(df, *fields):
    return rows(df.select(KIND, *fields))


def test_fold_fixture(spark):
    df = spark.createDataFrame(CHANGES, SCHEMA)
    assert rows(c.fold_changelog(df, keys=["id"])) == [(1, "A_1", 100), (3, "C", 100)]


def test_fold_under_any_partitioning_and_batching(spark):
    rng = random.Random(5)
    log, state = [], {}
    for seq in range(400):
        key = rng.choice([0, 0, rng.randrange(1, 12)])  # one key holds most changes
        if key in state and rng.random() < 0.3:
            log.append(("-D", key, state.pop(key), 0, seq))
        elif key in state:
            log.append(("-U", key, state[key], 0, seq))
            state[key] = f"v{seq}"
            log.append(("+U", key, state[key], 0, seq))
        else:
            state[key] = f"v{seq}"
            log.append(("+I", key, state[key], 0, seq))
    want = sorted(((k, v, 0) for k, v in state.items()), key=repr)
    df = spark.createDataFrame(log, SCHEMA)
    for n in (1, 3, 7):
        assert rows(c.fold_changelog(df.repartition(n), keys=["id"])) == want
    target = spark.createDataFrame([], "id bigint, name string, score int")
    for low in range(0, 400, 150):  # batch by batch gives the same as all at once
        part = df.where((F.col(SEQ) >= low) & (F.col(SEQ) < low + 150))
        target = c.apply_changelog(target, part, keys=["id"])
    assert rows(target) == want


def test_apply_is_idempotent_and_may_keep_deletes(spark):
    target = spark.createDataFrame([(1, "x", 0), (9, "y", 0)], "id bigint, name string, score int")
    df = spark.createDataFrame(CHANGES, SCHEMA)
    once = c.apply_changelog(target, df, keys=["id"])
    assert rows(once) == [(1, "A_1", 100), (3, "C", 100), (9, "y", 0)]
    assert rows(c.apply_changelog(once, df, keys=["id"])) == rows(once)
    kept = c.apply_changelog(target, df, keys=["id"], enable_delete=False)
    assert (2, "B", 100) in rows(kept)


def test_apply_leaves_a_big_target_in_place(spark):
    """Changes of a known, small size are broadcast: the target has no exchange of its own."""
    path = scratch_dir(spark, "changes")
    spark.createDataFrame(CHANGES, SCHEMA).write.parquet(path)
    target = spark.range(100_000_000).selectExpr("id", "'n' as name", "1 as score")
    text = plan_of(c.apply_changelog(target, spark.read.parquet(path), keys=["id"]))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    # The changes were folded and written before; the target is not moved.
    assert "Exchange hashpartitioning" not in text


def test_fold_ranks_before_the_shuffle(spark):
    df = spark.createDataFrame(CHANGES, SCHEMA)
    text = plan_of(c.fold_changelog(df, keys=["id"]))
    assert text.index("Final") < text.index("Exchange") < text.index("row_number(), 1, Partial")


def test_fold_by_a_precombine_field_and_compound_keys(spark):
    df = spark.createDataFrame(
        [("+I", "a", 1, "old", 5), ("+U", "a", 1, "new", 9), ("+U", "a", 1, "mid", 7), ("+I", "a", 2, "other", 1)],
        f"`{KIND}` string, k1 string, k2 int, v string, version int",
    )
    assert rows(c.fold_changelog(df, keys=["k1", "k2"], order_by="version")) == [("a", 1, "new", 9), ("a", 2, "other", 1)]


def test_retractions(spark):
    df = spark.createDataFrame([("+I", "a"), ("+I", "a"), ("-U", "a"), ("+U", "b"), ("+I", "c"), ("-D", "c"), ("+I", None)], f"`{KIND}` string, v string")
    assert rows(c.fold_retractions(df)) == [("a",), ("b",), (None,)]


def test_retractions_of_a_hot_row(spark, monkeypatch):
    monkeypatch.setattr(c, "_COPIES_PER_CALL", 7)
    df = spark.range(100).selectExpr(f"if(id < 50, '+I', if(id < 60, '-D', '+I')) as `{KIND}`", "if(id < 60, 'hot', concat('v', id)) as v")
    counts = {r["v"]: r["count"] for r in c.fold_retractions(df).groupBy("v").count().collect()}
    assert counts["hot"] == 40 and len(counts) == 41


def test_changes_between_inverts_apply(spark):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "b"), (4, None)], "id int, v string")
    diff = c.changes_between(old, new, keys=["id"])
    assert shown(diff, "id", "v") == [("+I", 4, None), ("+U", 2, "b"), ("-D", 3, "c"), ("-U", 2, None)]
    assert rows(c.apply_changelog(old, diff.withColumn(SEQ, F.lit(0)), keys=["id"])) == rows(new)
    assert c.changes_between(old, old, keys=["id"]).count() == 0


def test_startup_modes(spark):
    df = spark.createDataFrame(CHANGES, SCHEMA)
    snapshot = spark.createDataFrame([(7, "S", 1)], "id bigint, name string, score int")
    assert c.snapshot_then_changes(snapshot, df).count() == 7
    assert c.snapshot_then_changes(None, df, startup_mode="specific", position=3).count() == 1
    assert c.snapshot_then_changes(None, df, startup_mode="earliest").count() == 6
    with pytest.raises(ValueError):
        c.snapshot_then_changes(None, df)
    with pytest.raises(ValueError):
        c.snapshot_then_changes(None, df, startup_mode="latest")


def _image(weight):
    return {"id": 111, "name": "scooter", "weight": weight}


def test_debezium(spark):
    source = {"db": "inventory", "table": "products", "ts_ms": 1589362330000}
    df = messages(
        spark,
        {"before": _image(5.18), "after": _image(5.17), "source": source, "op": "u", "ts_ms": 1589362330904},
        {"before": None, "after": _image(1.0), "source": source, "op": "r"},
        {"before": _image(2.0), "after": None, "source": source, "op": "d"},
        None,
    )
    done = m.decode_debezium(df, schema=PRODUCT)
    assert shown(done, "weight", SEQ) == [("+I", 1.0, 1), ("+U", 5.17, 0), ("-D", 2.0, 2), ("-U", 5.18, 0)]
    first = done.first()
    assert (first[TABLE], first[EVENT_MS]) == ("inventory.products", 1589362330000)


@pytest.mark.parametrize("body", ["{broken", '{"op":"x"}', '{"op":"u","after":{"id":1}}', "[]"])
def test_bad_debezium(spark, body):
    df = messages(spark, body, {"op": "c", "after": _image(1.0)})
    assert m.decode_debezium(df, schema=PRODUCT, ignore_errors=True).count() == 1
    with pytest.raises(Exception, match="cannot decode"):
        m.decode_debezium(df, schema=PRODUCT).collect()


def test_canal_null_and_absent_in_old(spark):
    df = messages(
        spark,
        {
            "data": [{"id": "111", "name": "scooter", "weight": "5.18"}, {"id": "112", "name": "bike", "weight": "9"}],
            "old": [{"weight": None}, {"name": "byke"}],
            "database": "inventory", "table": "products", "type": "UPDATE", "es": 1589373560000, "isDdl": False,
        },
        {"data": None, "type": "ALTER", "isDdl": True, "database": "inventory", "table": "products"},
        {"data": [{"id": "1", "name": "n", "weight": "1"}], "type": "DELETE", "database": "other", "table": "products", "es": 1},
    )
    done = m.decode_canal(df, schema=PRODUCT, database_include="inv.*")
    assert shown(done, "id", "name", "weight") == [
        ("+U", 111, "scooter", 5.18), ("+U", 112, "bike", 9.0), ("-U", 111, "scooter", None), ("-U", 112, "byke", 9.0),
    ]


def test_canal_value_that_does_not_fit(spark):
    df = messages(spark, {"data": [{"id": "x", "name": "n", "weight": "1"}], "type": "INSERT"})
    assert shown(m.decode_canal(df, schema=PRODUCT, ignore_errors=True), "id", "name") == [("+I", None, "n")]
    with pytest.raises(Exception):
        m.decode_canal(df, schema=PRODUCT).collect()


def test_maxwell(spark):
    df = messages(
        spark,
        {"database": "test", "table": "product", "type": "insert", "ts": 1596684904, "data": _image(5.15)},
        {"database": "test", "table": "product", "type": "update", "ts": 2, "data": _image(5.2), "old": {"weight": 5.15}},
        {"database": "test", "table": "product", "type": "delete", "ts": 3, "data": _image(5.2)},
        {"database": "test", "table": "other", "type": "delete", "ts": 3, "data": _image(5.2)},
    )
    done = m.decode_maxwell(df, schema=PRODUCT, table_include="product")
    assert shown(done, "weight", EVENT_MS) == [("+I", 5.15, 1596684904000), ("+U", 5.2, 2000), ("-D", 5.2, 3000), ("-U", 5.15, 2000)]


def test_ogg(spark):
    df = messages(
        spark,
        {"before": _image(5.18), "after": _image(5.15), "op_type": "U", "op_ts": "2020-05-13 15:40:06.000000", "table": "PRODUCTS"},
        {"before": None, "after": _image(1.0), "op_type": "I", "table": "PRODUCTS"},
        {"before": _image(1.0), "op_type": "D", "table": "PRODUCTS"},
    )
    done = m.decode_ogg(df, schema=PRODUCT)
    assert shown(done, "weight") == [("+I", 1.0), ("+U", 5.15), ("-D", 1.0), ("-U", 5.18)]
    assert done.where(f"`{KIND}` = '+U'").first()[EVENT_MS] == 1589384406000


@pytest.mark.parametrize("fmt", ["debezium", "canal", "maxwell", "ogg"])
def test_encode_then_decode(spark, fmt):
    df = spark.createDataFrame(
        [("+I", 1, "a", 1.5), ("-U", 1, "a", 1.5), ("+U", 1, None, 2.5), ("-D", 2, "b", None)], f"`{KIND}` string, id int, name string, weight double"
    )
    back = getattr(m, f"decode_{fmt}")(m.encode_changelog(df, fmt=fmt), schema=PRODUCT)
    assert shown(back, "id", "name", "weight") == [
        ("+I", 1, "a", 1.5), ("+I", 1, None, 2.5), ("-D", 1, "a", 1.5), ("-D", 2, "b", None),
    ]


def test_connect_json(spark):
    df = messages(
        spark,
        {"schema": {}, "payload": _image(1.0)},
        {"schema": {}, "payload": {"before": _image(1.0), "after": _image(2.0), "op": "u"}},
        {"payload": None},
    )
    done = m.decode_connect_json(df, schema=PRODUCT, ignore_errors=True)
    assert shown(done, "weight") == [("+I", 1.0), ("+U", 2.0), ("-U", 1.0)]


def test_plain_messages(spark):
    df = spark.createDataFrame([("1|a",), ("2|",)], "value string")
    assert rows(m.decode_text(df, delimiter="|", schema={"id": "int", "name": "string"})) == [(1, "a"), (2, None)]
    bad = spark.createDataFrame([("{",)], "value string")
    assert rows(m.decode_json(bad, schema={"id": "int"}, ignore_errors=True)) == [(None,)]
    with pytest.raises(Exception):
        m.decode_json(bad, schema={"id": "int"}).collect()
    keyed = m.to_messages(spark.createDataFrame([(1, None)], "id int, v string"), key_fields=["id"], topic="t").first()
    assert (keyed["topic"], bytes(keyed["key"]), bytes(keyed["value"])) == ("t", b'{"id":1}', b'{"id":1,"v":null}')


def test_binary_formats_need_their_package(spark):
    df = spark.createDataFrame([(b"x",)], "value binary")
    if not m.has_format(spark, "avro"):
        with pytest.raises(RuntimeError):
            m.decode_avro(df, avro_schema="{}")
    if not m.has_format(spark, "protobuf"):
        with pytest.raises(RuntimeError):
            m.decode_protobuf(df, message="M", descriptor="d")


def test_evolution_rules(spark):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    done = e.evolve_schema(
        df, [e.AddColumn("w", "double", default=1.5, first=True), e.ModifyColumn("id", "bigint"), e.RenameColumn("v", "name"), e.DropColumn("id")]
    )
    assert done.columns == ["w", "name"] and rows(done) == [(1.5, "a")]
    for bad in (e.AddColumn("id", "int"), e.DropColumn("nope"), e.RenameColumn("id", "v"), e.ModifyColumn("v", "int"), e.ModifyColumn("id", "smallint")):
        with pytest.raises(ValueError):
            e.evolve_schema(df, [bad])
    with pytest.raises(ValueError):
        e.evolve_tables(TableSet.of({"a": df}), [e.RenameTable("b", "c")])
    # Events become one projection.
    assert plan_of(done).count("Project") <= 1


@pytest.mark.parametrize(
    "decode, message",
    [
        (m.decode_debezium, '{"op":"c","after":{"k":"abc","v":1}}'),
        (m.decode_ogg, '{"op_type":"I","table":"A.B","after":{"k":"abc","v":1}}'),
        (m.decode_connect_json, '{"payload":{"k":"abc","v":1}}'),
    ],
)
def test_a_value_of_the_wrong_type_is_an_error(spark, decode, message):
    """It raises, or is NULL when errors are ignored; a number written as text is a number."""
    df = spark.createDataFrame([(message,), (message.replace("abc", "7"),)], "value string")
    schema = T.StructType().add("k", "long").add("v", "long")
    with pytest.raises(Exception, match="abc"):
        decode(df, schema=schema).collect()
    assert [(r.k, r.v) for r in decode(df, schema=schema, ignore_errors=True).collect()] == [(None, 1), (7, 1)]


def test_changes_without_a_kind_are_refused(spark):
    df = spark.createDataFrame([(1, None, 1)], f"id int, {KIND} string, {SEQ} long")
    for fold in (lambda: c.fold_changelog(df, keys=["id"]), lambda: c.fold_retractions(df)):
        with pytest.raises(Exception, match="no __kind"):
            fold().collect()
