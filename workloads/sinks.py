"""File, table and payload sinks, save modes, many tables, assertions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.envelope import TableMeta, TableSet
from millrace.operators import validate
from millrace.operators.sql import sql
from millrace.session import list_paths, scratch_dir
from millrace.sinks import files, outbox, payloads, tables as sinks
from millrace.sources.files import scan_file
from millrace.storage import remove
from millrace.streaming.scan import scan_stream
from millrace.streaming.sinks import run_to_end
from workloads.registry import query, table


@query(
    "write_files_roundtrip",
    "SELECT o_orderpriority, o_orderkey, CAST(o_totalprice AS VARCHAR) AS o_totalprice FROM orders",
)
def write_files_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "files")
    files.write_files(
        table(spark, sf, "orders"),
        path,
        fmt="csv",
        field_delimiter="|",
        header=True,
        sink_columns=["o_orderpriority", "o_orderkey", "o_totalprice"],
    )
    schema = {"o_orderpriority": "string", "o_orderkey": "bigint", "o_totalprice": "string"}
    return scan_file(spark, path, fmt="csv", delimiter="|", schema=schema, skip_header_row_number=1)


@query(
    "write_partitioned",
    """SELECT l_orderkey, l_linenumber, l_returnflag, l_returnflag AS folder FROM lineitem""",
)
def write_partitioned(spark, sf):
    """The partition column names the folders and stays in the files."""
    path = scratch_dir(spark, "partitioned")
    files.write_files(
        table(spark, sf, "lineitem"),
        path,
        sink_columns=["l_orderkey", "l_linenumber", "l_returnflag"],
        partition_by=["l_returnflag"],
        is_partition_field_write_in_file=True,
    )
    return spark.read.parquet(path).withColumnRenamed(files.PARTITION_COPY.format("l_returnflag"), "folder")


def _target(spark) -> tuple[str, str]:
    """A table name and a location nobody else uses."""
    return f"mr_{uuid.uuid4().hex}", scratch_dir(spark, "table")


def _read_and_drop(spark, name: str, location: str) -> DataFrame:
    """The table's rows from its location; the catalog entry of the external table goes."""
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(location)


@query("save_mode_append", "SELECT c_custkey, c_name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def save_mode_append(spark, sf):
    name, location = _target(spark)
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    sinks.save_table(customers, name, location=location)
    more = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"))
    sinks.save_table(more, name, schema_save_mode="ERROR_WHEN_SCHEMA_NOT_EXIST")
    return _read_and_drop(spark, name, location)


@query("save_mode_drop_data", "SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0")
def save_mode_drop_data(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    rows = customers.where("c_acctbal > 0").select("c_custkey", "c_name")
    # A table Spark owns, in a database of its own, and an external one: each is emptied its own way.
    database, (name, location) = f"mr_{uuid.uuid4().hex}", _target(spark)
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_dir(spark, 'db')}'")
    for target, options in ((f"{database}.owned", {}), (name, {"location": location})):
        sinks.save_table(customers.select("c_custkey", "c_name"), target, **options)
        sinks.save_table(rows, target, data_save_mode="DROP_DATA", **options)
    kept = scratch_dir(spark, "kept")
    spark.table(f"{database}.owned").intersectAll(spark.table(name)).write.parquet(kept)
    spark.sql(f"DROP DATABASE {database} CASCADE")
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(kept)


@query("save_mode_recreate", "SELECT c_custkey, c_mktsegment FROM customer")
def save_mode_recreate(spark, sf):
    """The old table had other columns."""
    name, location = _target(spark)
    customer = table(spark, sf, "customer")
    sinks.save_table(customer.select("c_custkey", "c_name"), name, location=location)
    fresh = scratch_dir(spark, "table")
    sinks.save_table(
        customer.select("c_custkey", "c_mktsegment"), name, schema_save_mode="RECREATE_SCHEMA", location=fresh
    )
    return _read_and_drop(spark, name, fresh)


@query("save_mode_custom", "SELECT n_nationkey, n_name, 'kept' AS state FROM nation UNION ALL SELECT c_custkey::INTEGER, c_name, 'new' FROM customer")
def save_mode_custom(spark, sf):
    """The custom statement runs between the schema step and the write."""
    name, location = _target(spark)
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name", F.lit("kept").alias("state"))
    view = f"v_{uuid.uuid4().hex}"
    nation.createOrReplaceTempView(view)
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("int").alias("n_nationkey"), F.col("c_name").alias("n_name"), F.lit("new").alias("state")
    )
    sinks.save_table(
        rows, name, data_save_mode="CUSTOM_PROCESSING", custom_sql=f"INSERT INTO {name} SELECT * FROM {view}", location=location
    )
    spark.catalog.dropTempView(view)
    return _read_and_drop(spark, name, location)


@query("save_mode_errors", "SELECT count(*) AS n_rows, true AS missing_refused, true AS data_refused FROM customer")
def save_mode_errors(spark, sf):
    name, location = _target(spark)
    customers = table(spark, sf, "customer")

    def refused(**modes) -> bool:
        try:
            sinks.save_table(customers, name, **modes)
        except ValueError:
            return True
        return False

    missing = refused(schema_save_mode="ERROR_WHEN_SCHEMA_NOT_EXIST")
    sinks.save_table(customers, name, location=location)
    full = refused(data_save_mode="ERROR_WHEN_DATA_EXISTS")
    rows = _read_and_drop(spark, name, location)
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(missing).alias("missing_refused"), F.lit(full).alias("data_refused")
    )


@query(
    "insert_partitioned_table",
    """SELECT o_orderkey, 'new' AS mark, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT o_orderkey, 'old', o_orderstatus FROM orders WHERE o_orderstatus <> 'F'""",
)
def insert_partitioned_table(spark, sf):
    """All partitions are written, then one is overwritten; the others stay."""
    name, location = _target(spark)
    orders = table(spark, sf, "orders")
    old = orders.select("o_orderkey", F.lit("old").alias("mark"), "o_orderstatus")
    sinks.create_table(old, name, partition_by=["o_orderstatus"], location=location)
    sinks.insert_table(old, name)
    sinks.insert_table(old.where("o_orderstatus = 'F'").withColumn("mark", F.lit("new")), name, overwrite=True)
    return _read_and_drop(spark, name, location)


@query(
    "multi_table_sink",
    """SELECT 'ods_shop.nation_v1' AS target, count(*) AS n_rows, sum(n_nationkey)::BIGINT AS key_sum FROM nation
       UNION ALL SELECT 'ods_none.part_v1', count(*), sum(p_partkey)::BIGINT FROM part
       UNION ALL SELECT 'ods_shop.customer_v1', count(*), sum(c_custkey)::BIGINT FROM customer""",
)
def multi_table_sink(spark, sf):
    tables = TableSet.of(
        {"shop.nation": table(spark, sf, "nation"), "part": table(spark, sf, "part"), "shop.customer": table(spark, sf, "customer")}
    )
    root = scratch_dir(spark, "many")
    names = sinks.write_many(
        tables,
        lambda df, name: files.write_files(df, f"{root}/{name}"),
        database="ods_${database_name:none}",
        table="${table_name}_v1",
        at_once=3,
    )
    out = None
    for name in names.values():
        rows = spark.read.parquet(f"{root}/{name}")
        one = rows.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(rows.columns[0]).alias("key_sum"))
        one = one.select(F.lit(name).alias("target"), "n_rows", "key_sum")
        out = one if out is None else out.unionByName(one)
    return out


@query("create_from_template", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def create_from_template(spark, sf):
    name, location = _target(spark)
    df = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    sinks.create_from_template(
        spark,
        df,
        "CREATE TABLE IF NOT EXISTS `${table}` (\n  c_custkey,\n  ${rowtype_fields}\n) USING parquet COMMENT '${comment}' LOCATION '"
        + location
        + "'",
        table=name,
        meta=TableMeta(primary_key=("c_custkey",), comment="customers"),
    )
    sinks.insert_table(df, name)
    return _read_and_drop(spark, name, location)


@query(
    "assert_rules",
    """SELECT 'MIN_ROW' AS rule, '*' AS field, true AS ok, count(*) AS observed FROM orders WHERE o_totalprice > 100000
       UNION ALL SELECT 'MAX_ROW', '*', count(*) <= 10, count(*) FROM orders WHERE o_totalprice > 100000
       UNION ALL SELECT 'TYPE', 'id', true, 0
       UNION ALL SELECT 'NOT_NULL', 'id', true, 0
       UNION ALL SELECT 'MIN', 'price', false, count(*) FILTER (o_totalprice < 150000) FROM orders WHERE o_totalprice > 100000
       UNION ALL SELECT 'MIN_LENGTH', 'status', true, 0
       UNION ALL SELECT 'EQUALS', 'status', false, count(*) FILTER (o_orderstatus <> 'F') FROM orders WHERE o_totalprice > 100000""",
)
def assert_rules(spark, sf):
    """Scan, SQL transform, file sink, and assertions over what was written."""
    done = sql(
        scan_file(spark, f"{sf}/orders.parquet"),
        "select o_orderkey as id, concat(o_orderstatus, '_') as status, o_totalprice as price from dual where o_totalprice > 100000",
    )
    path = scratch_dir(spark, "asserted")
    files.write_files(done, path)
    return validate.assert_table(
        scan_file(spark, path),
        row_rules=[{"rule_type": "MIN_ROW", "rule_value": 1}, {"rule_type": "MAX_ROW", "rule_value": 10}],
        field_rules=[
            {"field_name": "id", "field_type": "bigint", "field_value": [{"rule_type": "NOT_NULL"}]},
            {"field_name": "price", "field_value": [{"rule_type": "MIN", "rule_value": 150000}]},
            {"field_name": "status", "field_value": [{"rule_type": "MIN_LENGTH", "rule_value": 2}, {"equals_to": "F_"}]},
        ],
    )


@query(
    "pack_json_batches",
    "SELECT count(*) AS n_rows, true AS within_size, sum(o_orderkey)::BIGINT AS key_sum FROM orders",
)
def pack_json_batches(spark, sf):
    """Every row is in one payload, and no payload is too long."""
    bodies = payloads.pack_json_batches(table(spark, sf, "orders"), batch_size=1000, array_mode=True)
    rows = F.from_json("body", "array<struct<o_orderkey:bigint>>")
    return bodies.select("n_rows", F.size(rows).alias("found"), F.aggregate(rows, F.lit(0).cast("bigint"), lambda a, r: a + r["o_orderkey"]).alias("k")).agg(
        F.sum("found").cast("bigint").alias("n_rows"),
        F.bool_and((F.col("n_rows") <= 1000) & (F.col("n_rows") == F.col("found"))).alias("within_size"),
        F.sum("k").alias("key_sum"),
    )


@query(
    "json_objects",
    """SELECT '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}' AS body, CAST(1 AS BIGINT) AS n_rows FROM customer""",
)
def json_objects(spark, sf):
    return payloads.pack_json_batches(table(spark, sf, "customer").select("c_custkey", "c_name"))


@query("document_id", "SELECT l_orderkey || '$' || l_linenumber || '$' || l_returnflag AS _id, l_orderkey FROM lineitem")
def document_id(spark, sf):
    done = payloads.document_id(
        table(spark, sf, "lineitem"), primary_keys=["l_orderkey", "l_linenumber", "l_returnflag"], delimiter="$"
    )
    return done.select("_id", "l_orderkey")


@query("console_sink", "SELECT * FROM customer")
def console_sink(spark, sf):
    df = table(spark, sf, "customer")
    payloads.console(df, print_data=False)
    return df


@query("stream_payload_outbox", "SELECT c_custkey, 1 AS times FROM customer")
def stream_payload_outbox(spark, sf):
    """Payload batches of a stream in two runs. Each run is killed after its payloads were committed and before Spark noted
    that, so its last epoch comes again: every customer arrives once."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    source, path, checkpoint = (scratch_dir(spark, x) for x in ("customers", "outbox", "checkpoint"))
    for half in (F.col("c_custkey") % 2 == 0, F.col("c_custkey") % 2 == 1):
        customers.where(half).write.mode("append").parquet(source)
        for _ in range(2):
            bodies = payloads.pack_json_batches(scan_stream(spark, source, schema=customers.schema), batch_size=50, array_mode=True)
            run_to_end(outbox.stream_to_outbox(bodies, path, checkpoint))
            last = max(list_paths(spark, f"{checkpoint}/commits/*"), key=lambda p: int(p.rsplit("/", 1)[1]))
            remove(spark, last)
    sent = outbox.sent_payloads(spark, path).select(F.explode(F.from_json("body", "array<struct<c_custkey:bigint>>")).alias("row"))
    return sent.groupBy(F.col("row.c_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).cast("int").alias("times"))
