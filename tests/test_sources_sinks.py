import json

import pytest
from pyspark.sql import functions as F

from millrace import options as o
from millrace.envelope import KIND, SEQ, TableMeta, TablePath, TableSet
from millrace.operators.rowkind import define_sink_type
from millrace.plans import splits
from millrace.plans.flow import build_flow, run_flow
from millrace.plans.variables import substitute
from millrace.schema import align_schema, schema_from_spec, spark_type, widens
from millrace.session import scratch_dir, scratch_root
from millrace.sinks import files as fs, jdbc, payloads, tables as ts
from millrace.sources import documents, files, generate, jdbc as jdbc_source, markdown
from millrace.sources.tables import scan_table, scan_tables
from tests.conftest import plan_of, rows


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv", "text", "json"])
def test_round_trip_with_nulls_and_odd_text(spark, fmt):
    df = spark.createDataFrame(
        [(1, 'a"b', 1.5, None), (2, None, None, True), (3, "x\\y;z, w", -0.0, False)], "id int, t string, d double, b boolean"
    )
    path = scratch_dir(spark, fmt)
    fs.write_files(df, path, fmt=fmt, null_format="\\N")
    options = {} if fmt in ("parquet", "orc") else {"schema": df.schema, "null_format": "\\N"}
    assert rows(files.scan_file(spark, path, fmt=fmt, **options)) == rows(df)


def test_empty_input_still_writes_the_schema(spark):
    df = spark.createDataFrame([], "id int, t string")
    path = scratch_dir(spark, "empty")
    fs.write_files(df, path)
    assert spark.read.parquet(path).columns == ["id", "t"]


def test_partition_columns_in_and_out_of_files(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id int, k string")
    out, kept, rebalanced = (scratch_dir(spark, n) for n in ("out", "kept", "rb"))
    fs.write_files(df, out, partition_by=["k"])
    fs.write_files(df, kept, partition_by=["k"], is_partition_field_write_in_file=True)
    fs.write_files(df, rebalanced, partition_by=["k"], rebalance=True)
    assert spark.read.parquet(f"{out}/k=x").columns == ["id"]
    assert spark.read.parquet(f"{kept}/{fs.PARTITION_COPY.format('k')}=x").columns == ["id", "k"]
    assert rows(spark.read.parquet(rebalanced)) == rows(df)


def test_partitions_prune_and_must_agree(spark):
    df = spark.range(20).selectExpr("id", "id % 4 as a", "id % 2 as b")
    path = scratch_dir(spark, "parts")
    fs.write_files(df, path, partition_by=["a", "b"])
    read = files.scan_file(spark, path, read_partitions=["a=0/b=0", "a=3/b=1"])
    assert rows(read.select("id")) == rows(df.where("a in (0, 3)").select("id"))
    assert "PartitionFilters: [(((a#" in plan_of(read)
    with pytest.raises(ValueError):
        files.scan_file(spark, path, read_partitions=["a=0", "a=3/b=1"])
    with pytest.raises(ValueError):
        files.scan_file(spark, path, read_partitions=["a"])


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    df = files.source_filter(files.scan_file(spark, f"{sf_dir}/lineitem.parquet", read_columns=["l_orderkey", "l_quantity"]), "l_quantity > 30")
    text = plan_of(df)
    assert "GreaterThan(l_quantity,30.0)" in text and "l_shipdate" not in text


def test_choosing_files(spark):
    path = scratch_dir(spark, "chosen")
    spark.range(3).write.parquet(path)
    assert files.scan_file(spark, path, modified_after="2000-01-01T00:00:00").count() == 3
    assert files.scan_file(spark, path, schema={"id": "bigint"}, modified_before="2000-01-01T00:00:00").count() == 0
    assert files.scan_file(spark, path, file_filter_pattern=r"part-.*\.parquet").count() == 3
    assert files.scan_file(spark, path, file_filter_pattern=r"part").count() == 0
    assert files.scan_file(spark, path, schema={"id": "bigint"}, extension="orc").count() == 0


def test_key_ranges(spark):
    df = spark.range(10)
    assert rows(files.key_range_scan(df, "id", 2, 4)) == [(2,), (3,)]
    assert rows(files.key_range_scan(df, "id", 2, 4, start_inclusive=False, end_inclusive=True)) == [(3,), (4,)]
    assert files.key_range_scan(df, "id", None, 3).count() == 3 and files.key_range_scan(df, "id").count() == 10


def test_skip_lines_of_every_file(spark):
    path = scratch_dir(spark, "lines")
    for part in range(3):
        lines = ["h1", "h2", *[f"{part},{i}" for i in range(50)]]
        spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("append").text(path)
    read = files.scan_file(spark, path, fmt="csv", schema={"a": "int", "b": "int"}, skip_header_row_number=2)
    assert read.count() == 150 and read.where("a is null").count() == 0
    # A file cut into several splits has its header lines in the first only.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        small = files.scan_file(spark, path, fmt="csv", schema={"a": "int", "b": "int"}, skip_header_row_number=2)
        assert rows(small) == rows(read)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_long_row_delimiter(spark):
    path = scratch_dir(spark, "rows")
    spark.createDataFrame([("1;a||2;b",)], "value string").coalesce(1).write.option("lineSep", "||").text(path)
    read = files.scan_file(spark, path, fmt="text", delimiter=";", row_delimiter="||", schema={"id": "int", "t": "string"})
    assert rows(read) == [(1, "a"), (2, "b")]


def test_catalog_patterns(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS pat_a")
    spark.sql("CREATE DATABASE IF NOT EXISTS pat_b")
    for name in ("pat_a.user_1", "pat_a.user_2", "pat_a.shop", "pat_b.user_1"):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (id INT, k STRING) USING parquet PARTITIONED BY (k)")
    assert [str(p) for p in scan_tables(spark, r"pat_a\.user_\d")] == ["pat_a.user_1", "pat_a.user_2"]
    assert len(scan_tables(spark, r"pat_a\..*")) == 3
    assert len(scan_tables(spark, r"pat_.\..*")) == 4
    spark.sql("INSERT INTO pat_a.shop VALUES (1, 'x'), (2, 'y')")
    assert rows(scan_table(spark, "pat_a.shop", read_partitions=["k=y"], read_columns=["id"])) == [(2,)]


def test_scratch_follows_the_session(spark):
    assert scratch_dir(spark, "x").startswith(scratch_root(spark))
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


# Splits.


@pytest.mark.parametrize("size", [1, 7, 100, 5000])
def test_even_splits_cover_once(spark, size):
    df = spark.range(10, 1010).selectExpr("id", "cast(id as string) as t")
    bounds = splits.plan_splits(df, "id", split_size=size, max_splits=300)
    assert len(bounds) <= 300
    hits = sum(F.expr(p).cast("int") for p in splits.split_predicates("id", bounds))
    assert rows(df.select(hits.alias("n")).distinct()) == [(1,)]


def test_sampled_splits_of_skewed_and_text_keys(spark):
    df = spark.range(3000).selectExpr("if(id < 1000, 5, id * id) as k", "if(id < 1000, 'hot', concat('it''s ', id)) as t", "if(id % 50 = 0, null, id) as n")
    for column in ("k", "t", "n"):
        bounds = splits.plan_splits(df, column, split_size=200, even_upper=0.5 if column == "n" else 100.0)
        assert len(bounds) > 4
        hits = sum(F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in splits.split_predicates(column, bounds))
        assert rows(df.select(hits.alias("n")).distinct()) == [(1,)]
        counted = df.groupBy(splits.split_number(df, column, bounds).alias("s")).count()
        assert counted.agg(F.sum("count")).first()[0] == 3000


def test_small_table_is_one_split(spark):
    assert splits.plan_splits(spark.range(5), "id") == [(None, None)]
    assert splits.split_predicates("id", [(None, None)]) == ["1 = 1"]


def test_remote_names():
    assert jdbc_source.remote_table("t", None) == "t"
    assert jdbc_source.remote_table(None, "select 1;") == "(select 1) mr_query"
    with pytest.raises(ValueError):
        jdbc_source.remote_table("t", "select 1")


def test_merge_statements():
    merge, drop = jdbc.merge_statements("t", "s", ["id", "v"], ["id"])
    assert merge == (
        "MERGE INTO t t USING s s ON t.id = s.id WHEN MATCHED AND s.mr_kind = '-D' THEN DELETE"
        " WHEN MATCHED THEN UPDATE SET v = s.v WHEN NOT MATCHED AND s.mr_kind <> '-D' THEN INSERT (id, v) VALUES (s.id, s.v)"
    )
    assert drop == "DROP TABLE s"
    assert "UPDATE" not in jdbc.merge_statements("t", "s", ["id"], ["id"])[0]


def test_statement_per_row(spark):
    """Each task gets a connection of its own; what it ran is written to a folder the test can read."""
    folder = scratch_dir(spark, "statements")

    def connect():
        import os
        import uuid

        class Recorder:
            def __init__(self):
                os.makedirs(folder, exist_ok=True)
                self.path = f"{folder}/{uuid.uuid4().hex}"

            def cursor(self):
                return self

            def executemany(self, statement, batch):
                with open(self.path, "a") as out:
                    out.writelines(f"{statement}{row}\n" for row in batch)

            def commit(self):
                pass

            def close(self):
                pass

        return Recorder()

    df = spark.range(25).selectExpr("id", "'v' as v").repartition(3)
    jdbc.write_statement(df, connect, "INSERT", columns=["id"], batch_size=4)
    assert spark.read.text(folder).count() == 25


# Save modes: the truth table.


@pytest.mark.parametrize("schema_mode", ts.SCHEMA_SAVE_MODES)
@pytest.mark.parametrize("exists", [True, False])
def test_schema_modes(spark, schema_mode, exists):
    name = f"sm_{schema_mode.lower()}_{exists}"
    old, new = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(1,)], "b int")
    if exists:
        ts.save_table(old, name)
    if schema_mode == "ERROR_WHEN_SCHEMA_NOT_EXIST" and not exists:
        with pytest.raises(ValueError):
            ts.prepare_target(new, name, schema_save_mode=schema_mode)
        return
    ts.prepare_target(new, name, schema_save_mode=schema_mode)
    if schema_mode == "RECREATE_SCHEMA":
        want = ["b"]
    elif schema_mode == "IGNORE" and not exists:
        assert not spark.catalog.tableExists(name)
        return
    else:
        want = ["a"] if exists else ["b"]
    assert spark.table(name).columns == want
    spark.sql(f"DROP TABLE {name}")


def test_data_modes(spark):
    df = spark.createDataFrame([(1,)], "a int")
    ts.save_table(df, "dm")
    ts.save_table(df, "dm", data_save_mode="APPEND_DATA")
    assert spark.table("dm").count() == 2
    with pytest.raises(ValueError):
        ts.save_table(df, "dm", data_save_mode="ERROR_WHEN_DATA_EXISTS")
    ts.save_table(df, "dm", data_save_mode="DROP_DATA")
    assert spark.table("dm").count() == 1
    with pytest.raises(ValueError):
        ts.save_table(df, "dm", data_save_mode="CUSTOM_PROCESSING")
    # After a restore the table is not recreated.
    assert ts.prepare_target(df, "dm", schema_save_mode="RECREATE_SCHEMA", restored=True) is False
    assert spark.table("dm").count() == 1
    assert ts.prepare_target(df, "dm", schema_save_mode="RECREATE_SCHEMA") is True
    assert spark.table("dm").count() == 0
    spark.sql("DROP TABLE dm")


def test_declared_sink_types_reach_the_table(spark):
    df = define_sink_type(spark.createDataFrame([(1, "x")], "a int, b string"), columns=[{"column": "a", "type": "decimal(20,0)"}])
    ts.save_table(df, "dst")
    assert dict(spark.table("dst").dtypes) == {"a": "decimal(20,0)", "b": "string"}
    spark.sql("DROP TABLE dst")
    with pytest.raises(ValueError):
        define_sink_type(df, columns=[{"column": "nope", "type": "int"}])


def test_placeholders(spark):
    df = spark.createDataFrame([(1, "x")], "id int, v string")
    meta = TableMeta(primary_key=("id", "v"), unique_keys=(("v",),), comment="note")
    path = TablePath("t", "db", "sc")

    def name(template, p=path, m=meta):
        return ts.resolve_name(template, p, df, m)

    assert name("${database_name}_test.${schema_name}.${table_name}_x") == "db_test.sc.t_x"
    assert name("${schema_full_name}/${table_full_name}") == "db.sc/db.sc.t"
    assert name("${primary_key}|${unique_key}|${field_names}|${comment}") == "id,v|v|id,v|note"
    lone = TablePath("t")
    assert name("${database_name:none}.${schema_name}.${table_name}", lone) == "none..t"
    assert name("${primary_key}", lone, TableMeta()) == "${primary_key}"
    with pytest.raises(ValueError):
        ts.write_many(TableSet.of({"a.t": df, "b.t": df}), lambda d, n: None, database=None, table="${table_name}")


def test_ddl_template(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "id int, v string, d double")
    text = ts.render_template(
        df, "CREATE TABLE `${table}` (\n  id,\n  v varchar(9) NOT NULL,\n  ${rowtype_fields},\n  PRIMARY KEY (${rowtype_primary_key})\n) COMMENT '${comment}'",
        table="t", meta=TableMeta(primary_key=("id",), comment="it's"),
    )
    assert "`id` int," in text and "`v` varchar(9) NOT NULL," in text and "`d` double,\n" in text
    assert "PRIMARY KEY (`id`)" in text and "it\\'s" in text
    with pytest.raises(ValueError):
        ts.render_template(df, "${rowtype_primary_key}", table="t")


def test_payloads(spark):
    df = spark.range(0, 25, 1, 2).selectExpr("id", "cast(null as string) as v")
    bodies = payloads.pack_json_batches(df, batch_size=10, array_mode=True).collect()
    assert sum(r["n_rows"] for r in bodies) == 25 and max(r["n_rows"] for r in bodies) == 10
    assert len(bodies) == 4  # one short batch per task
    assert sorted(x["id"] for r in bodies for x in json.loads(r["body"])) == list(range(25))
    assert payloads.pack_json_batches(df).count() == 25
    assert rows(payloads.document_id(df.limit(1), primary_keys=["id", "id"], delimiter="$").select("_id")) == [("0$0",)]


def test_console(spark, capsys):
    payloads.console(spark.range(2))
    payloads.console(spark.range(2), print_data=False)
    assert capsys.readouterr().out.count("root") == 2


# Schemas and options.


def test_types():
    assert spark_type("map<string, {c_int = int, c_row = {c_int = int}}>").simpleString() == "map<string,struct<c_int:int,c_row:struct<c_int:int>>>"
    assert spark_type('map<string, {"c_int":"int"}>').simpleString() == "map<string,struct<c_int:int>>"
    wanted = {"null": "void", "bytes": "binary", "timestamp": "timestamp_ntz", "timestamp_tz": "timestamp", "time": "string",
              "decimal(30, 8)": "decimal(30,8)", "map<string, map<string, array<int>>>": "map<string,map<string,array<int>>>",
              "array<timestamp>": "array<timestamp_ntz>", "float_vector": "array<float>", "sparse_float_vector": "map<int,float>"}
    assert {k: spark_type(k).simpleString() for k in wanted} == wanted


def test_schema_spellings():
    assert schema_from_spec(None).names == ["content"]
    nested = schema_from_spec({"fields": {"a.b": "int", "r": {"x": "string", "y": {"z": "date"}}}})
    assert nested.simpleString() == "struct<a.b:int,r:struct<x:string,y:struct<z:date>>>"
    columns = schema_from_spec({"columns": [{"name": "id", "type": "bigint", "nullable": False, "defaultValue": 0, "comment": "c", "columnLength": 4294967295}]})
    assert columns["id"].metadata == {"comment": "c", "length": 4294967295, "default": 0} and not columns["id"].nullable


def test_widening_rule():
    t = spark_type
    for a, b in [("tinyint", "smallint"), ("smallint", "bigint"), ("int", "bigint"), ("float", "double"), ("float", "decimal(10,2)"),
                 ("double", "decimal(10,2)"), ("date", "string"), ("int", "int")]:
        assert widens(t(a), t(b)), (a, b)
    for a, b in [("bigint", "int"), ("double", "float"), ("string", "int"), ("int", "double"), ("decimal(10,2)", "double")]:
        assert not widens(t(a), t(b)), (a, b)


def test_align(spark):
    df = spark.createDataFrame([(1, None, "+I")], f"a int, b string, `{KIND}` string")
    schema = schema_from_spec({"columns": [
        {"name": "b", "type": "string", "defaultValue": "d"}, {"name": "a", "type": "bigint"},
        {"name": "m", "type": "map<string,int>", "defaultValue": {"k": 1}}]})
    done = align_schema(df, schema)
    assert done.columns == ["b", "a", "m", KIND] and tuple(done.first()) == ("d", 1, {"k": 1}, "+I")
    with pytest.raises(ValueError):
        align_schema(df, schema_from_spec({"fields": {"a": "smallint"}}))


def test_option_rules():
    o.require({"a": 1}, "a")
    assert o.exactly_one({"a": 1, "b": None}, "a", "b") == "a"
    o.bundled({"a": 1, "b": 2}, "a", "b")
    o.conditional({"m": "X", "a": 1}, "m", "X", "a")
    o.conditional({"m": "Y"}, "m", "X", "a")
    for call in (
        lambda: o.require({"a": ""}, "a"),
        lambda: o.exactly_one({"a": 1, "b": 2}, "a", "b"),
        lambda: o.bundled({"a": 1}, "a", "b"),
        lambda: o.conditional({"m": "X"}, "m", "X", "a"),
        lambda: o.single_choice({"m": "Z"}, "m", ("X",)),
    ):
        with pytest.raises(ValueError):
            call()


# Generated and shaped rows.


def test_generated_rows_do_not_depend_on_partitions(spark):
    schema = {"i": "int", "s": "string", "a": "array<double>", "m": "map<int,string>", "r": {"d": "date", "t": "timestamp"},
              "b": "boolean", "y": "bytes", "n": "null", "f": "float", "dec": "decimal(12,3)"}
    one = generate.generate(spark, schema=schema, row_num=50, parallelism=1)
    many = generate.generate(spark, schema=schema, row_num=50, parallelism=7)
    assert rows(one) == rows(many) and one.count() == 50
    assert rows(one) != rows(generate.generate(spark, schema=schema, row_num=50, seed=1))
    assert one.select("s").distinct().count() == 50


def test_generate_defaults_and_ids(spark):
    schema = {"columns": [{"name": "id", "type": "int"}, {"name": "v", "type": "string", "defaultValue": "d"}]}
    df = generate.generate(spark, schema=schema, row_num=50, parallelism=4, auto_increment={"id": 100})
    assert rows(df) == [(100 + i, "d") for i in range(50)]


def test_literal_rows(spark):
    df = generate.literal_rows(
        spark, schema={"id": "bigint", "t": "timestamp", "a": "array<int>", "d": "date"},
        rows=[("+I", (1, "2024-01-01 00:00:00", "[1,2]", None)), ("DELETE", (2, "CURRENT_TIMESTAMP", None, "CURRENT_DATE"))],
    )
    first, second = df.orderBy(SEQ).collect()
    assert (first["a"], first[KIND], second[KIND]) == ([1, 2], "+I", "-D") and second["t"] is not None and second["d"] is not None
    with pytest.raises(ValueError):
        generate.literal_rows(spark, schema={"id": "int"}, rows=[("+I", (1, 2))])


MARKDOWN = """# Title
intro line one
intro line two

## Part *A*
- item one
  more of it
1. item two

| a | b |
|---|---|
| 1 | 2 |

```python
# not a heading

x = 1
```
### Deep ###
text
---
***
# Last
~~~
open fence
"""


def test_markdown(spark):
    df = spark.createDataFrame([(1, MARKDOWN), (2, ""), (3, None)], "doc int, text string")
    found = {r["position_index"]: r for r in markdown.markdown_elements(df).collect()}
    got = [(r["element_type"], r["heading_level"], r["text"], r["parent_id"]) for _, r in sorted(found.items())]
    assert got == [
        ("Heading", 1, "Title", None),
        ("Paragraph", None, "intro line one\nintro line two", "heading_1"),
        ("Heading", 2, "Part *A*", "heading_1"),
        ("ListItem", None, "item one\n  more of it", "heading_3"),
        ("ListItem", None, "item two", "heading_3"),
        ("Table", None, "| a | b |\n|---|---|\n| 1 | 2 |", "heading_3"),
        ("CodeBlock", None, "# not a heading\n\nx = 1", "heading_3"),
        ("Heading", 3, "Deep", "heading_3"),
        ("Heading", 2, "text", "heading_1"),
        ("Heading", 1, "Last", None),
        ("CodeBlock", None, "open fence\n", "heading_10"),
    ]
    assert found[1]["child_ids"] == "paragraph_2,heading_3,heading_9" and found[2]["child_ids"] == ""
    assert {r["doc"] for r in found.values()} == {1} and found[1]["page_number"] == 1


def test_markdown_of_a_very_long_document(spark):
    text = "\n".join("word" for _ in range(60_000)) + "\n\n" + "\n\n".join(f"# h{i}" for i in range(5_000))
    df = spark.createDataFrame([(1, text)], "doc int, text string")
    assert "Exchange" not in plan_of(markdown.markdown_elements(df))
    assert markdown.markdown_elements(df).count() == 5_001


def test_json_rows(spark):
    body = '{"store":{"book":[{"category":"a","price":1.5},{"category":"b"},{"price":3}],"bicycle":{"price":2}}}'
    df = spark.createDataFrame([(1, body), (2, "{}"), (3, None)], "id int, body string")
    found = documents.json_document_rows(df, column="body", content_field="$.store.book.*", schema={"category": "string", "price": "double"})
    assert rows(found) == [(1, "a", 1.5), (1, "b", None), (1, None, 3.0)]
    zipped = documents.json_document_rows(
        df, column="body", json_field={"c": "$.store.book[*].category", "p": "$.store.book[*].price"}, types={"p": "double"}
    )
    assert rows(zipped) == rows(found)
    one = documents.json_document_rows(df.where("id = 1"), column="body", json_field={"p": "$.store.bicycle.price"})
    assert rows(one) == [(1, "2")]
    with pytest.raises(ValueError):
        documents.json_document_rows(df, column="body")


def test_nested_wildcards(spark):
    df = spark.createDataFrame([('{"a":[{"b":[{"c":1},{"c":2}]},{"b":[{"c":3}]}]}',)], "body string")
    assert rows(documents.json_document_rows(df, column="body", json_field={"c": "$.a[*].b[*].c"})) == [("1",), ("2",), ("3",)]


def test_hash_rows(spark):
    df = spark.createDataFrame([({"001": '{"name":"x","age":26}', "002": '{"name":"y"}'},)], "h map<string,string>")
    assert rows(documents.hash_rows(df, map_col="h", mode="kv", schema={"k": "string", "name": "string", "age": "int"})) == [
        ("001", "x", 26), ("002", "y", None)]
    member = {"name": "string", "age": "int"}
    wide = documents.hash_rows(df, map_col="h", schema={"001": member, "003": member}).first()
    assert wide["001"]["age"] == 26 and wide["003"] is None


# Flows.


def test_variables():
    spec = {"a": "${x}-${y:2}", "b": ["${z:}", 5], "c": "${table_name}"}
    assert substitute(spec, {"x": "1"}, keep=frozenset({"table_name"})) == {"a": "1-2", "b": ["", 5], "c": "${table_name}"}
    with pytest.raises(KeyError):
        substitute("${x}", {})


def test_flow(spark, sf_dir):
    out = scratch_dir(spark, "flow")
    spec = {
        "source": [
            {"plugin_name": "File", "path": f"{sf_dir}/nation.parquet", "plugin_output": "n"},
            {"plugin_name": "Rows", "plugin_output": "r", "schema": {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"},
             "rows": [("+I", (99, "X", 1))]},
        ],
        "transform": [
            {"plugin_name": "Filter", "plugin_input": "r", "plugin_output": "plain", "exclude": [KIND, SEQ]},
            {"plugin_name": "Copy", "plugin_input": ["n", "plain"], "fields": {"copy": "n_name"}},
        ],
        "sink": [{"plugin_name": "File", "path": out}, {"plugin_name": "Assert", "row_rules": [{"rule_type": "MIN_ROW", "rule_value": 26}]}],
    }
    run_flow(spark, spec)
    assert spark.read.parquet(out).count() == 26
    for bad in ({"transform": [{"plugin_name": "Copy", "fields": {}}]}, {"source": [{"plugin_name": "Nope"}]},
                {"source": spec["source"], "transform": [{"plugin_name": "Copy", "plugin_input": "zzz", "fields": {}}]}):
        with pytest.raises(ValueError):
            build_flow(spark, bad)
    failing = {**spec, "sink": [{"plugin_name": "Assert", "row_rules": [{"rule_type": "MAX_ROW", "rule_value": 1}]}]}
    with pytest.raises(AssertionError):
        run_flow(spark, failing)


def test_column_comments_and_quotes(spark):
    schema = schema_from_spec({"columns": [{"name": "id", "type": "int", "comment": "the 'key'"}]})
    ts.create_table(spark.createDataFrame([], schema), "commented", comment="it's \\ here")
    found = {r["col_name"]: r["comment"] for r in spark.sql("DESCRIBE commented").collect()}
    assert found["id"] == "the 'key'"
    spark.sql("DROP TABLE commented")


def test_delimited_round_trips_keep_every_character(spark, tmp_path):
    data = [(1, " blanks "), (2, "two\nlines"), (3, ""), (4, None), (5, 'a "quoted", value'), (6, "back\\slash"), (7, "tab\t")]
    df = spark.createDataFrame(data, "id int, t string")
    path = str(tmp_path / "csv")
    fs.write_files(df, path, fmt="csv")
    assert rows(files.scan_file(spark, path, fmt="csv", schema={"id": "int", "t": "string"}, multi_line=True)) == rows(df)
    plain = df.where("id NOT IN (2, 3)")
    fs.write_files(plain, str(tmp_path / "text"), fmt="text", null_format="\\N")
    back = files.scan_file(spark, str(tmp_path / "text"), fmt="text", schema={"id": "int", "t": "string"}, null_format="\\N")
    assert rows(back) == rows(plain)
    fs.write_files(df.where("id = 3"), str(tmp_path / "empty"), fmt="text", null_format="\\N")
    back = files.scan_file(spark, str(tmp_path / "empty"), fmt="text", schema={"id": "int", "t": "string"}, null_format="\\N")
    assert rows(back) == [(3, None)]  # without quotes an empty value is a missing one
    with pytest.raises(Exception, match="text files cannot"):
        fs.write_files(df.where("id = 2"), str(tmp_path / "broken"), fmt="text")


def test_partition_text_and_fractions(spark, tmp_path):
    df = spark.sql("select 1 as id, timestamp_ntz'2024-01-02 03:04:05.123456' as at, '01' as part")
    path, pattern = str(tmp_path / "json"), "yyyy-MM-dd HH:mm:ss.SSSSSS"
    fs.write_files(df, path, fmt="json", partition_by=["part"], datetime_format=pattern)
    schema = {"id": "int", "at": "timestamp"}
    back = files.scan_file(spark, path, fmt="json", schema=schema, datetime_format=pattern, partition_types={"part": "string"})
    assert rows(back) == rows(df)
    fs.write_files(df, str(tmp_path / "pq"), partition_by=["part"])
    assert files.scan_file(spark, str(tmp_path / "pq"), partition_types={"part": "string"}).first().part == "01"


def test_field_names_like_types(spark):
    kind = spark_type("{time = int, name = string}")
    assert [f.name for f in kind.fields] == ["time", "name"]


def test_wide_generated_values(spark):
    df = generate.generate_columns(spark.range(200), id_col="id", schema={"b": "bytes", "d": "decimal(30,2)"}, bytes__length=100)
    got = df.selectExpr("min(octet_length(b)) as short", "max(octet_length(b)) as long", "max(d) as d").first()
    assert got.short == got.long == 100 and got.d > 10**26


def test_remote_split_planning():
    """The database is asked for statistics and quantiles, never for its keys. DuckDB stands in for it."""
    import duckdb

    db = duckdb.connect()
    db.execute("create table t as select case when i < 400 then 'hot' else 'k' || lpad(i::varchar, 4, '0') end as k, i * i as n from range(1000) r(i)")
    asked = []

    def ask(remote):
        asked.append(remote)
        return db.execute(f"select * from {remote}").fetchall()

    bounds = jdbc_source.remote_bounds(ask, "t", "k", 10)
    assert asked == [jdbc_source.quantile_query("t", "k", 10)] and 5 <= len(bounds) <= 10
    where = splits.split_predicates("k", bounds)
    assert sum(db.execute(f"select count(*) from t where {w}").fetchall()[0][0] for w in where) == 1000
    low, high, n = ask(jdbc_source.statistics_query("(select n from t) s", "n"))[0]
    assert (low, high, n) == (0, 999 * 999, 1000)
    even = splits.ranges_of(low, high, n, None, split_size=100, even_upper=2000.0)
    assert len(even) > 1 and even[0][0] is None and even[-1][1] is None
    assert len(splits.ranges_of(0, 10**9 - 1, 10**9, None, split_size=1000)) == 10**6
