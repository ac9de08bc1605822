"""Jobs as data, SQL statements, variables, declared schemas, parallelism."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.envelope import KIND, SEQ
from millrace.operators.changelog import fold_changelog
from millrace.plans.flow import run_flow, set_parallelism
from millrace.schema import align_schema, cast_to_schema, schema_from_fields, schema_from_spec
from millrace.session import scratch_dir
from millrace.sinks.keyed import KeyedTable
from millrace.sinks.tables import run_statements
from workloads.registry import query, table


@query(
    "flow_fanout",
    """SELECT 'cheap' AS branch, o_orderkey AS id, o_orderstatus AS label FROM orders WHERE o_totalprice <= 100000
       UNION ALL SELECT 'split', o_orderkey, split_part(o_orderpriority, '-', 1) FROM orders""",
)
def flow_fanout(spark: SparkSession, sf: str) -> DataFrame:
    """One source feeds two branches, each with its own sink."""
    cheap, split = scratch_dir(spark, "cheap"), scratch_dir(spark, "split")
    spec = {
        "source": [{"plugin_name": "File", "path": "${folder}/orders.parquet", "plugin_output": "orders"}],
        "transform": [
            {"plugin_name": "Sql", "plugin_input": ["orders"], "plugin_output": "cheap",
             "query": "select o_orderkey as id, o_orderstatus as label from dual where o_totalprice <= 100000"},
            {"plugin_name": "Split", "plugin_input": "orders", "plugin_output": "parts",
             "field": "o_orderpriority", "separator": "-", "output_fields": ["label", "rest"]},
            {"plugin_name": "FieldMapper", "plugin_output": "split", "mapping": {"o_orderkey": "id", "label": "label"}},
        ],
        "sink": [
            {"plugin_name": "File", "plugin_input": "cheap", "path": cheap},
            {"plugin_name": "File", "plugin_input": "split", "path": split},
            {"plugin_name": "Assert", "plugin_input": "cheap", "row_rules": [{"rule_type": "MIN_ROW", "rule_value": 1}]},
        ],
    }
    run_flow(spark, spec, {"folder": sf})
    parts = [spark.read.parquet(path).withColumn("branch", F.lit(name)) for name, path in (("cheap", cheap), ("split", split))]
    return parts[0].unionByName(parts[1])


@query(
    "sql_flow",
    "SELECT o_orderkey AS id, o_orderstatus || '!' AS label FROM orders WHERE o_custkey > 100",
)
def sql_flow(spark, sf):
    """A source view, a table as select, an insert into a sink table, all as statements."""
    tag, path = uuid.uuid4().hex, scratch_dir(spark, "sink")
    run_statements(
        spark,
        [
            f"CREATE TEMPORARY VIEW src_{tag} USING parquet OPTIONS (path '{sf}/orders.parquet')",
            f"CREATE TEMPORARY VIEW step_{tag} AS SELECT o_orderkey AS id, o_orderstatus AS label, o_custkey FROM src_{tag}",
            f"CREATE TABLE sink_{tag} (id BIGINT, label STRING) USING parquet LOCATION '{path}'",
            f"INSERT INTO sink_{tag} SELECT id, concat(label, '!') FROM step_{tag} WHERE o_custkey > 100",
            f"DROP TABLE sink_{tag}",
            f"DROP VIEW step_{tag}",
            f"DROP VIEW src_{tag}",
        ],
    )
    return spark.read.parquet(path)


@query(
    "flow_stream_keyed",
    """SELECT CAST(c_custkey AS BIGINT) AS k, c_name AS name, c_acctbal AS balance FROM customer WHERE c_mktsegment <> 'BUILDING'""",
)
def flow_stream_keyed(spark, sf):
    """A streaming job: messages from a folder, decoded and folded into a keyed table. Customers of one segment are
    deleted again."""
    folder, path, checkpoint = (scratch_dir(spark, x) for x in ("messages", "keyed", "checkpoint"))
    row = "named_struct('k', c_custkey, 'name', c_name, 'balance', c_acctbal)"
    customers = table(spark, sf, "customer")
    for seq, op, image, rows in ((0, "c", "after", customers), (1, "d", "before", customers.where("c_mktsegment = 'BUILDING'"))):
        body = F.expr(f"to_json(named_struct('op', '{op}', '{image}', {row}))")
        rows.select(body.alias("value"), F.lit(seq).cast("bigint").alias("__seq")).write.mode("append").parquet(folder)
    kinds = {"k": "bigint", "name": "string", "balance": "double"}
    spec = {
        "env": {"job.mode": "STREAMING"},
        "source": [{"plugin_name": "FileStream", "path": folder, "schema": {"value": "string", "__seq": "bigint"}}],
        "transform": [{"plugin_name": "DebeziumJson", "schema": kinds}],
        "sink": [{"plugin_name": "KeyedTable", "path": path, "checkpoint": checkpoint, "keys": ["k"], "schema": kinds}],
    }
    run_flow(spark, spec)
    return KeyedTable(spark, path, keys=["k"], schema=schema_from_fields(kinds)).read()


@query(
    "flow_routed_errors",
    """SELECT doc_id, 'kept' AS place FROM labels WHERE quality >= 1
       UNION ALL SELECT doc_id, 'rejected' FROM labels WHERE NOT quality >= 1""",
)
def flow_routed_errors(spark, sf):
    """A job whose rejected rows go to a table of their own."""
    good, bad = scratch_dir(spark, "good"), scratch_dir(spark, "bad")
    rules = [{"field_name": "quality", "rule_type": "RANGE", "min_value": 1}]
    spec = {
        "source": [{"plugin_name": "File", "path": f"{sf}/labels.parquet"}],
        "transform": [
            {"plugin_name": "DataValidator", "field_rules": rules, "row_error_handle_way": "ROUTE_TO_TABLE",
             "table": "db.labels", "plugin_output": "valid", "error_output": "errors"}
        ],
        "sink": [
            {"plugin_name": "File", "plugin_input": "valid", "path": good},
            {"plugin_name": "File", "plugin_input": "errors", "path": bad},
        ],
    }
    run_flow(spark, spec)
    kept = spark.read.parquet(good).select("doc_id", F.lit("kept").alias("place"))
    number = F.get_json_object("original_data", "$.doc_id").cast("bigint")
    return kept.unionByName(spark.read.parquet(bad).select(number.alias("doc_id"), F.lit("rejected").alias("place")))


_TWO_TABLES_SQL = """SELECT 'shop_CUSTOMERS' AS name, CAST(c_custkey AS BIGINT) AS k, c_name AS label FROM customer WHERE c_mktsegment <> 'BUILDING'
    UNION ALL SELECT 'shop_SUPPLIER', CAST(s_suppkey AS BIGINT), s_name || '!' FROM supplier"""


def _two_tables(spark, sf) -> tuple[str, dict]:
    """Change messages of two tables and of a third one nobody asks for, in one folder; and a job's fields for the two."""
    folder = scratch_dir(spark, "messages")
    for seq, op, image, name, rows in (
        (0, "c", "after", "customer", table(spark, sf, "customer").selectExpr("c_custkey AS k", "c_name AS label", "c_mktsegment AS s")),
        (1, "d", "before", "customer", table(spark, sf, "customer").selectExpr("c_custkey AS k", "c_name AS label", "c_mktsegment AS s").where("s = 'BUILDING'")),
        (0, "c", "after", "supplier", table(spark, sf, "supplier").selectExpr("s_suppkey AS k", "s_name AS label")),
        (0, "c", "after", "other", table(spark, sf, "nation").selectExpr("n_nationkey AS k", "n_name AS label")),
    ):
        source = f"named_struct('db', 'shop', 'table', '{name}')"
        body = F.expr(f"to_json(named_struct('op', '{op}', '{image}', named_struct('k', k, 'label', label), 'source', {source}))")
        rows.select(body.alias("value"), F.lit(seq).cast("bigint").alias("__seq")).write.mode("append").parquet(folder)
    fields = {"k": "bigint", "label": "string"}
    return folder, {"shop.customer": fields, "shop.supplier": fields}


def _two_tables_steps() -> list[dict]:
    """Rules for one table, and a rename by pattern."""
    rename = [{"replace_from": "^customer$", "replace_to": "customers"}]
    return [
        {"plugin_name": "Sql", "table_transform": [{"table_path": "shop.supplier", "query": "select k, concat(label, '!') as label from dual", "carry_envelope": True}]},
        {"plugin_name": "TableRename", "replacements_with_regex": rename, "convert_case": "UPPER"},
    ]


@query("flow_table_set", _TWO_TABLES_SQL)
def flow_table_set(spark, sf):
    """A batch job over the tables of one message folder; each is written with its placeholders filled in and folded."""
    folder, schemas = _two_tables(spark, sf)
    out = scratch_dir(spark, "tables")
    spec = {
        "source": [{"plugin_name": "MessageTables", "path": folder, "schemas": schemas}],
        "transform": _two_tables_steps(),
        "sink": [{"plugin_name": "File", "path": f"{out}/${{database_name}}_${{table_name}}", "sink_columns": ["k", "label", KIND, SEQ]}],
    }
    run_flow(spark, spec)
    parts = None
    for name in ("shop_CUSTOMERS", "shop_SUPPLIER"):
        one = fold_changelog(spark.read.parquet(f"{out}/{name}"), keys=["k"]).withColumn("name", F.lit(name))
        parts = one if parts is None else parts.unionByName(one)
    return parts


@query("flow_table_set_stream", _TWO_TABLES_SQL)
def flow_table_set_stream(spark, sf):
    """The same job as a stream: one query, a keyed table for each table."""
    folder, schemas = _two_tables(spark, sf)
    out, keys = scratch_dir(spark, "tables"), {name: ["k"] for name in schemas}
    spec = {
        "env": {"job.mode": "STREAMING"},
        "source": [{"plugin_name": "MessageTables", "path": folder, "schemas": schemas, "primary_keys": keys}],
        "transform": _two_tables_steps(),
        "sink": [{"plugin_name": "KeyedTable", "path": f"{out}/${{database_name}}_${{table_name}}", "checkpoint": scratch_dir(spark, "checkpoint")}],
    }
    run_flow(spark, spec)
    parts = None
    for name in ("shop_CUSTOMERS", "shop_SUPPLIER"):
        stored = KeyedTable(spark, f"{out}/{name}", keys=["k"], schema=schema_from_fields({"k": "bigint", "label": "string"}))
        one = stored.read().withColumn("name", F.lit(name))
        parts = one if parts is None else parts.unionByName(one)
    return parts


@query("flow_variables", "SELECT o_orderkey, 'none' AS note FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 50000")
def flow_variables(spark, sf):
    spec = {
        "source": [{"plugin_name": "File", "path": "${folder}/${table}.parquet"}],
        "transform": [
            {"plugin_name": "Sql", "plugin_output": "out",
             "query": "select o_orderkey, '${note:none}' as note from dual where o_orderstatus = '${status}' and o_totalprice > ${low:50000}"}
        ],
    }
    return run_flow(spark, spec, {"folder": sf, "table": "orders", "status": "F"})["out"]


@query(
    "schema_spec_cast",
    "SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_totalprice, o_orderdate FROM orders",
)
def schema_spec_cast(spark, sf):
    """Columns as text, read back by a declared schema."""
    text = table(spark, sf, "orders").select(
        *[F.col(name).cast("string") for name in ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")]
    )
    schema = schema_from_spec(
        {"fields": {"o_orderkey": "bigint", "o_custkey": "int", "o_totalprice": "double", "o_orderdate": "timestamp"}}
    )
    return cast_to_schema(text, schema)


@query(
    "align_schema",
    """SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, c_custkey, c_name, 'I''m default value' AS note,
              coalesce(CASE WHEN c_acctbal > 0 THEN c_acctbal END, -1) AS c_acctbal
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def align_schema_query(spark, sf):
    df = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("n_nationkey"), "c_custkey", "c_name", F.expr("if(c_acctbal > 0, c_acctbal, null)").alias("c_acctbal")
    )
    schema = schema_from_spec(
        {
            "columns": [
                {"name": "n_nationkey", "type": "bigint", "nullable": False, "defaultValue": 0, "comment": "key"},
                {"name": "c_custkey", "type": "bigint"},
                {"name": "c_name", "type": "string"},
                {"name": "note", "type": "string", "defaultValue": "I'm default value"},
                {"name": "c_acctbal", "type": "double", "defaultValue": -1},
            ]
        }
    )
    return align_schema(df, schema)


@query(
    "parallelism_invariance",
    """SELECT 'free' AS readers, count(*) AS n_rows, sum(l_orderkey)::BIGINT AS key_sum, false AS bounded FROM lineitem
       UNION ALL SELECT 'set', count(*), sum(l_orderkey)::BIGINT, true FROM lineitem""",
)
def parallelism_invariance(spark, sf):
    """The same result with and without a bound on the number of readers, over a copy in eight files; the bound binds."""
    path = scratch_dir(spark, "files")
    table(spark, sf, "lineitem").select("l_orderkey").repartition(8).write.parquet(path)
    parts = [spark.read.parquet(file) for file in sorted(spark.read.parquet(path).inputFiles())]
    lineitem = reduce(DataFrame.unionAll, parts)  # a file a reader, whatever the session's split size
    bounded = set_parallelism(lineitem, 3)
    out = None
    for name, rows in (("free", lineitem), ("set", bounded)):
        read = rows.withColumn("reader", F.spark_partition_id())
        few = (F.countDistinct("reader") <= 3).alias("bounded")
        one = read.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_orderkey").alias("key_sum"), few)
        one = one.withColumn("readers", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out
