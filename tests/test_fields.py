import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.envelope import KIND, TableMeta, TablePath, TableSet
from millrace.operators import fields, jsonpath, models, rowkind, tables
from millrace.operators.sql import QueryError, sql, sql_steps
from tests.conftest import plan_of, rows


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [(1, "Joy Ding", 20), (2, "May Ding", 21), (3, "Kin Dom", 24), (4, "Joy Dom", 22)], "id int, name string, age int"
    )


def test_copy_refuses_unknown_and_clash(people):
    assert rows(fields.copy_fields(people, fields={"n2": "name"}).select("n2"))[0] == ("Joy Ding",)
    with pytest.raises(ValueError):
        fields.copy_fields(people, fields={"x": "nope"})
    with pytest.raises(ValueError):
        fields.copy_fields(people, fields={"age": "name"})


def test_mapper_order_and_filter_choice(people):
    assert fields.field_mapper(people, mapping={"age": "a", "id": "i"}).columns == ["a", "i"]
    assert fields.filter_fields(people, include=["age", "id"]).columns == ["age", "id"]
    with pytest.raises(ValueError):
        fields.filter_fields(people, include=["id"], exclude=["age"])
    with pytest.raises(ValueError):
        fields.filter_fields(people)


def test_dotted_names(spark):
    df = spark.createDataFrame([(1, "a")], "`t.long` bigint, `t.string` string")
    assert rows(fields.copy_fields(df, fields={"c": "t.string"}).select("c")) == [("a",)]
    assert fields.field_mapper(df, mapping={"t.long": "t.id"}).columns == ["t.id"]
    assert fields.rename_fields(df, prefix="x_").columns == ["x_t.long", "x_t.string"]


def test_rename_rules(people):
    done = fields.rename_fields(
        people,
        convert_case="UPPER",
        suffix="_s",
        replacements_with_regex=[{"replace_from": "a(.)e", "replace_to": "$1"}],
        specific=[{"field_name": "id", "target_name": "key"}],
    )
    # name -> n + m, age -> g; specific skips every other rule
    assert done.columns == ["key", "NM_s", "G_s"]
    with pytest.raises(ValueError):
        fields.rename_fields(people, replacements_with_regex=[{"replace_from": ".*", "replace_to": "x"}])


@pytest.mark.parametrize(
    "text, pattern, replacement, want",
    [
        ("a1b2", r"(\d)", "<$1>", "a<1>b2"),
        ("abc", "$", "X", "abcX"),
        ("abc", "b*", "X", "Xabc"),
        ("", "x*", "Y", "Y"),
        ("none", r"\d", "X", "none"),
        ("a\nb\nc", "b", "X", "a\nX\nc"),
        ("aXbX", "(?i)x", "-", "a-bX"),
        ("foobar foobaz", r"foo(?=baz)", "X", "foobar Xbaz"),
        ("ab", r"(a)(b)", "$2$1", "ba"),
        (None, "a", "b", None),
    ],
)
def test_replace_first_only(spark, text, pattern, replacement, want):
    df = spark.createDataFrame([(text,)], "t string")
    done = fields.replace(df, field="t", pattern=pattern, replacement=replacement, is_regex=True, replace_first=True)
    assert rows(done) == [(want,)]


def test_replace_literal_and_all(spark):
    df = spark.createDataFrame([("a.b.c",), (None,)], "t string")
    assert rows(fields.replace(df, field="t", pattern=".", replacement="-")) == [("a-b-c",), (None,)]
    assert rows(fields.replace(df, field="t", pattern=".", replacement="-", is_regex=True)) == [("-----",), (None,)]


def test_split_limit_missing_null(spark):
    df = spark.createDataFrame([("a b c",), ("a",), ("",), (None,)], "t string")
    done = fields.split_field(df, field="t", separator=" ", output_fields=["x", "y"])
    assert {tuple(r) for r in done.collect()} == {("a b c", "a", "b c"), ("a", "a", None), ("", "", None), (None, None, None)}


def test_regex_extract_defaults(spark):
    df = spark.createDataFrame([(1, "user1@example.com"), (2, None), (3, "nothing")], "id int, email string")
    args = dict(field="email", pattern=r"([^@]+)@([^.]+)\.(.+)", output_fields=["u", "d", "t"])
    done = fields.regex_extract(df, **args, default_values=["unknown"] * 3).drop("email")
    assert rows(done) == [(1, "user1", "example", "com"), (2,) + ("unknown",) * 3, (3,) + ("unknown",) * 3]
    assert rows(fields.regex_extract(df, **args).drop("email"))[1] == (2, None, None, None)
    with pytest.raises(ValueError):
        fields.regex_extract(df, field="email", pattern="(a)", output_fields=["u", "d"])


def test_projections_do_not_shuffle(people):
    done = fields.split_field(fields.copy_fields(people, fields={"n": "name"}), field="name", separator=" ", output_fields=["a", "b"])
    done = fields.replace(done, field="n", pattern="J", replacement="j")
    plan = plan_of(rowkind.extract_row_kind(rowkind.with_kind(done)))
    assert "Exchange" not in plan and "Python" not in plan


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame(
        [
            (1, '{"a":{"b":1},"l":[1,2],"n":null,"s":"x","m":[{"k":"v"}]}'),
            (2, '{"a":{"b":"oops"}}'),
            (3, '{"a":'),
            (4, None),
        ],
        "id int, j string",
    )


def _column(path, dest="out", kind="string", way=None):
    out = {"src_field": "j", "path": path, "dest_field": dest, "dest_type": kind}
    return {**out, "column_error_handle_way": way} if way else out


def test_json_path_values(documents):
    good = documents.where("id = 1")
    done = jsonpath.json_path(
        good,
        columns=[
            _column("$.a.b", "b", "int"),
            _column("$.l", "l", "array<int>"),
            _column("$.n", "n", "string"),
            _column("$.l[1]", "l1", "bigint"),
            _column("$.m", "m", "array<map<string,string>>"),
            _column("$.m[*].k", "k", "string"),
            _column("$['a']", "obj", "string"),
        ],
    ).drop("id", "j")
    # What a wildcard selects is an array, for one match too.
    assert tuple(done.first()) == (1, [1, 2], None, 2, [{"k": "v"}], '["v"]', '{"b":1}')


def test_json_path_error_ways(documents):
    skip = jsonpath.json_path(documents, columns=[_column("$.a.b", "b", "int", "SKIP")]).select("id", "b")
    assert rows(skip) == [(1, 1), (2, None), (3, None), (4, None)]
    drop = jsonpath.json_path(documents, columns=[_column("$.a.b", "b", "int", "SKIP_ROW")]).select("id", "b")
    assert rows(drop) == [(1, 1), (4, None)]
    row_skip = jsonpath.json_path(documents, columns=[_column("$.s")], row_error_handle_way="SKIP").select("id", "out")
    assert rows(row_skip) == [(1, "x"), (4, None)]
    with pytest.raises(Exception, match="no usable"):
        jsonpath.json_path(documents, columns=[_column("$.a.b", "b", "int")]).collect()
    # A column's own way beats the row's way.
    mixed = jsonpath.json_path(documents, columns=[_column("$.s", way="SKIP")], row_error_handle_way="FAIL")
    assert mixed.count() == 4


@pytest.mark.parametrize("path", ["$..b", "$[?(@.a)]", "a.b", "$.a[-1]", "$.a[0:2]", "$.a.length()"])
def test_json_path_refuses_unsupported(documents, path):
    with pytest.raises(ValueError):
        jsonpath.json_path(documents, columns=[_column(path)])


def test_json_path_lists_and_sources(spark):
    df = spark.sql("select named_struct('a', 'x', 'b', map('k', 18)) as j, array(1, 2) as arr, map('k', 'v') as m")
    done = jsonpath.json_path(
        df,
        columns=[
            {"src_field": "j", "path": ["$[0]", "$[1].k"], "dest_field": ["p", "q"], "dest_type": ["string", "int"]},
            {"src_field": "arr", "path": "$[1]", "dest_field": "r", "dest_type": "int"},
            {"src_field": "m", "path": "$.k", "dest_field": "s"},
        ],
    )
    assert tuple(done.select("p", "q", "r", "s").first()) == ("x", 18, 2, "v")
    with pytest.raises(ValueError):
        jsonpath.json_path(df, columns=[{"src_field": "j", "path": ["$[0]"], "dest_field": ["p"]}])


def test_row_kinds(spark):
    df = spark.createDataFrame([("+I", 1), ("-U", 1), ("+U", 1), ("-D", 2)], f"`{KIND}` string, id int")
    assert rows(rowkind.filter_row_kind(df, include=["+U", "DELETE"])) == [("+U", 1), ("-D", 2)]
    assert rows(rowkind.filter_row_kind(df, exclude=["-U"])) == [("+I", 1), ("+U", 1), ("-D", 2)]
    full = rowkind.extract_row_kind(df, field="op", transform_type="FULL")
    assert {r["op"] for r in full.collect()} == {"INSERT", "UPDATE_BEFORE", "UPDATE_AFTER", "DELETE"}
    assert {r[KIND] for r in full.collect()} == {"+I"}
    with pytest.raises(ValueError):
        rowkind.extract_row_kind(df, field="id")
    with pytest.raises(ValueError):
        rowkind.filter_row_kind(df, include=["+X"])


def test_metadata(spark):
    df = spark.sql("select 1 as id, 'db.s.t' as __table, array('a', 'b') as __partition")
    done = rowkind.add_metadata(df, metadata_fields={"Database": "d", "Table": "t", "Partition": "p", "Delay": "x"})
    assert tuple(done.select("d", "t", "p", "x").first()) == ("db", "t", "a,b", None)
    with pytest.raises(ValueError):
        rowkind.add_metadata(df, metadata_fields={"database": "d"})
    with pytest.raises(ValueError):
        rowkind.add_metadata(df, metadata_fields={"Table": "id"})


def test_event_time_ignores_negative(spark):
    df = spark.createDataFrame([(-5,), (1000,)], "ts bigint")
    done = rowkind.event_time_and_delay(df, ts_col="ts", extracted_at_ms=F.lit(3000))
    assert rows(done.select("__event_ms", "__delay_ms")) == [(1000, 2000), (None, None)]


def _set(spark, *names):
    return TableSet.of({name: spark.createDataFrame([(1, name)], "id int, name string") for name in names})


def test_table_filters_and_renames(spark):
    five = _set(spark, "test.user_1", "test.user_22", "test.shop", "prod.user_1", "lone")
    kept = tables.filter_tables(five, database_pattern="test", table_pattern=r"user_\d+")
    assert [str(p) for p in kept] == ["test.user_1", "test.user_22"]
    rest = tables.filter_tables(five, database_pattern="test", table_pattern=r"user_\d+", pattern_mode="EXCLUDE")
    assert [str(p) for p in rest] == ["test.shop", "prod.user_1", "lone"]
    named = tables.rename_table(kept, convert_case="UPPER", suffix="_x", replacements_with_regex=[{"replace_from": "user", "replace_to": "u"}])
    assert [str(p) for p in named] == ["test.U_1_x", "test.U_22_x"]
    with pytest.raises(ValueError):
        tables.rename_table(kept, replacements_with_regex=[{"replace_from": r"_\d+", "replace_to": ""}])


def test_rule_precedence(spark):
    five = _set(spark, "test.abc", "test.abcd", "test.xyz", "test.xyzxyz", "test.www")

    def copy(name):
        return lambda df: fields.copy_fields(df, fields={name: "name"})

    done = tables.for_tables(
        five, copy("name1"), table_match_regex="test.a.*", table_transform={"test.xyz": copy("name2"), "test.xyzxyz": copy("name3")}
    )
    assert [df.columns[2:] for df in done.values()] == [["name1"], ["name1"], ["name2"], ["name3"], []]
    with pytest.raises(ValueError):
        tables.for_tables(five, table_transform={"test.nope": copy("x")})


def test_merge_is_strict(spark):
    merged = tables.merge_tables(_set(spark, "s.a", "s.b"), table="all", database="d")
    assert [str(p) for p in merged] == ["d.all"] and merged["d.all"].count() == 2
    odd = TableSet.of({"a": spark.range(1), "b": spark.range(1).toDF("x")})
    with pytest.raises(Exception):
        tables.merge_tables(odd, table="all")["all"].count()


def test_keys_survive_only_whole():
    meta = TableMeta(primary_key=("a", "b"), unique_keys=(("a",), ("c",)), partition_keys=("c",))
    after = meta.after(["a", "c"])
    assert after.primary_key == () and after.unique_keys == (("a",), ("c",)) and after.partition_keys == ("c",)
    assert str(TablePath.parse("d.s.t")) == "d.s.t"
    assert TablePath.parse("s.t", schema_first=True).schema == "s"


def test_sql(people):
    done = sql(people, "select id, concat(name, '_') as name, age + 1 as age from dual where id > 0")
    assert rows(done) == [(1, "Joy Ding_", 21), (2, "May Ding_", 22), (3, "Kin Dom_", 25), (4, "Joy Dom_", 23)]
    assert rows(sql_steps(people, "select age from dual", "select max(age) from dual")) == [(24,)]
    # Unknown in WHERE drops the row.
    assert sql(people, "select id from dual where cast(null as boolean)").count() == 0
    assert sql(people, "select * from people", table_name="people").count() == 4
    with pytest.raises(Exception):
        sql(people, "select nope from dual")
    assert not people.sparkSession.catalog.tableExists("dual")


def test_sql_carries_envelope(people):
    kinds = rowkind.with_kind(people, F.when(F.col("id") == 1, "-D").otherwise("+I"))
    done = sql(kinds, "select name from dual where id < 3", carry_envelope=True)
    assert rows(done) == [("Joy Ding", "-D"), ("May Ding", "+I")]
    assert sql(kinds, "select * from dual", carry_envelope=True).columns.count(KIND) == 1


def test_models(people):
    def echo(prompt, batch):
        return [prompt + n if n.startswith("J") else None for n in batch["name"]]

    done = models.infer_column(people, prompt=">", model_fn=echo, inference_columns=["name"])
    assert {r["llm_output"] for r in done.collect()} == {">Joy Ding", ">Joy Dom", None}
    typed = models.infer_column(people, prompt="", model_fn=lambda p, b: ["1", "x", "3", "4"][: len(b)], output_type="INT", output_column="n")
    assert typed.schema["n"].dataType.simpleString() == "int"
    with pytest.raises(ValueError):
        models.infer_column(people, prompt="", model_fn=echo, output_column="name")

    def fail(prompt, batch):
        raise RuntimeError("model is down")

    with pytest.raises(Exception, match="model is down"):
        models.infer_column(people, prompt="", model_fn=fail).collect()

    def double(batch):
        return pd.DataFrame({"age": batch["age"] * 2, "tag": "t"})

    made = models.custom_rows(people, double, out_columns={"age": "bigint", "tag": "string"})
    assert made.columns == ["id", "name", "age", "tag"] and rows(made)[0] == (1, "Joy Ding", 40, "t")


def test_sql_leaves_views_of_the_caller(spark):
    spark.range(3).createOrReplaceTempView("mine")
    df = spark.range(5)
    assert sql(df, "select count(*) as n from mine", table_name="mine").first().n == 5
    assert spark.table("mine").count() == 3
    spark.catalog.dropTempView("mine")
    assert not spark.catalog.tableExists("dual")


@pytest.mark.parametrize(
    "query", ["select distinct id from dual", "with x as (select id from dual) select id from x", "select id from dual union all select id from dual", "select id, count(*) from dual group by id"]
)
def test_envelope_needs_a_plain_select(spark, query):
    df = spark.range(3).withColumn("__kind", F.lit("+I"))
    with pytest.raises(QueryError):
        sql(df, query, carry_envelope=True)
    assert sql(df, "select id + 1 as i from dual where id > 0 order by id", carry_envelope=True).columns == ["i", "__kind"]


def test_query_errors_are_named(spark):
    for query in ("selec 1", "select nothing from dual", "select id from dual where id ="):
        with pytest.raises(QueryError, match="in '"):
            sql(spark.range(1), query)
