import json

import pytest
from pyspark.sql import functions as F

from millrace.envelope import TableMeta, TableSet
from millrace.operators import validate as v
from tests.conftest import plan_of, rows


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame(
        [(123, None, 200, "invalid-email"), (1, "Ann", 30, "ann@example.com"), (2, "Bob", None, None)],
        "id int, name string, age int, email string",
    )


RULES = [
    {"field_name": "name", "rule_type": "NOT_NULL"},
    {"field_name": "age", "rules": [{"rule_type": "RANGE", "min_value": 0, "max_value": 150}]},
    {"field_name": "email", "rule_type": "UDF", "function_name": "EMAIL", "custom_message": "bad address"},
]


def test_route(users):
    routed = v.validate_route(users, field_rules=RULES, table="database.users")
    assert rows(routed.valid) == [(1, "Ann", 30, "ann@example.com"), (2, "Bob", None, None)]
    assert routed.errors.columns == ["source_table_id", "source_table_path", "original_data", "validation_errors", "create_time"]
    (error,) = routed.errors.collect()
    assert json.loads(error["original_data"]) == {"id": 123, "name": None, "age": 200, "email": "invalid-email"}
    assert json.loads(error["validation_errors"]) == [
        {"field_name": "name", "error_message": "Field 'name' cannot be null"},
        {"field_name": "age", "error_message": "Field 'age' value 200 is not within range [0, 150]"},
        {"field_name": "email", "error_message": "bad address"},
    ]
    assert error["source_table_path"] == "database.users"
    assert "Exchange" not in plan_of(routed.errors)


def test_fail_raises_in_any_action(users):
    bad = v.validate(users, field_rules=RULES)
    with pytest.raises(Exception, match="cannot be null"):
        bad.count()
    assert v.validate(users.where("id < 100"), field_rules=RULES).count() == 2


def test_skip_and_fail_fast(users):
    assert v.validate(users, field_rules=RULES, row_error_handle_way="SKIP").count() == 2
    errors = v.validation_errors(users, field_rules=RULES, fail_fast=True)
    assert {len(r[0]) for r in users.select(errors).collect()} == {0, 1}


def test_bounds(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "x double")

    def kept(**rule):
        return rows(v.validate(df, field_rules=[{"field_name": "x", "rule_type": "RANGE", **rule}], row_error_handle_way="SKIP"))

    assert kept(min_value=1, min_inclusive=False) == [(2.0,), (3.0,), (None,)]
    assert kept(max_value=2, max_inclusive=False) == [(1.0,), (None,)]
    assert kept(min_value=1, max_value=2) == [(1.0,), (2.0,), (None,)]


def test_length_on_collections(spark):
    df = spark.createDataFrame([("ab", [1], {"k": 1}), ("", [], {}), (None, None, None)], "s string, a array<int>, m map<string,int>")
    for field in ("s", "a", "m"):
        rule = {"field_name": field, "rule_type": "LENGTH", "min_length": 1}
        assert v.validate(df, field_rules=[rule], row_error_handle_way="SKIP").count() == 2


def test_regex_case_and_custom_check(spark):
    df = spark.createDataFrame([("ABC",), ("abc",), (None,)], "t string")
    strict = [{"field_name": "t", "rule_type": "REGEX", "pattern": "^[a-z]+$"}]
    loose = [{**strict[0], "case_sensitive": False}]
    assert v.validate(df, field_rules=strict, row_error_handle_way="SKIP").count() == 2
    assert v.validate(df, field_rules=loose, row_error_handle_way="SKIP").count() == 3

    @F.pandas_udf("boolean")
    def short(s):
        return s.str.len() < 3

    rule = [{"field_name": "t", "rule_type": "UDF", "function_name": "SHORT"}]
    assert v.validate(df, field_rules=rule, functions={"SHORT": short}, row_error_handle_way="SKIP").count() == 1
    with pytest.raises(ValueError):
        v.validate(df, field_rules=rule)


@pytest.mark.parametrize(
    "address, good",
    [("a@b.co", True), ("first.last+tag@sub.example.org", True), ("no-at", False), ("a@b", False), ("a..b@c.com", False),
     ("x" * 65 + "@example.com", False), ("", False)],
)
def test_email(spark, address, good):
    df = spark.createDataFrame([(address,)], "e string")
    assert df.select(v.is_email(F.col("e"))).first()[0] is good


def test_assert_table(users):
    result = v.assert_table(
        users,
        row_rules=[{"rule_type": "MIN_ROW", "rule_value": 3}, {"rule_type": "MAX_ROW", "rule_value": 2}],
        field_rules=[
            {"field_name": "id", "field_type": "int", "field_value": [{"rule_type": "NOT_NULL"}, {"rule_type": "MIN", "rule_value": 1}]},
            {"field_name": "age", "field_type": "bigint", "field_value": [{"rule_type": "MAX", "rule_value": 100}]},
            {"field_name": "gone", "field_value": [{"rule_type": "NOT_NULL"}]},
        ],
    )
    assert {(r["rule"], r["field"]): r["ok"] for r in result.collect()} == {
        ("MIN_ROW", "*"): True,
        ("MAX_ROW", "*"): False,
        ("TYPE", "id"): True,
        ("NOT_NULL", "id"): True,
        ("MIN", "id"): True,
        ("TYPE", "age"): False,
        ("MAX", "age"): False,
        ("EXISTS", "gone"): False,
    }
    with pytest.raises(AssertionError):
        v.require_assertions(result)


def test_assert_tables(spark, users):
    tables = TableSet.of({"db.users": users, "db.ids": spark.range(3)}, {"db.ids": TableMeta(primary_key=("id",))})
    result = v.assert_tables(
        tables,
        tables_configs=[
            {"table_path": "db.users", "row_rules": [{"rule_type": "MIN_ROW", "rule_value": 4}]},
            {"table_path": "db.ids", "primary_key": ["id"], "field_rules": [{"field_name": "id", "field_value": [{"rule_type": "MAX", "rule_value": 2}]}]},
        ],
    )
    assert rows(result.select("table_path", "rule", "ok")) == [
        ("db.ids", "MAX", True), ("db.ids", "PRIMARY_KEY", True), ("db.users", "MIN_ROW", False),
    ]
    with pytest.raises(ValueError):
        v.assert_tables(tables, tables_configs=[{"table_path": "db.nope"}])


def test_decimal_type_rule(spark):
    df = spark.sql("select cast(1 as decimal(10,2)) as d")
    for kind, ok in (("decimal(10,2)", True), ("decimal(10,3)", False)):
        assert v.assert_table(df, field_rules=[{"field_name": "d", "field_type": kind}]).first()["ok"] is ok
