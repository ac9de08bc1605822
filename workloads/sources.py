"""Scans, generated rows, split planning and JSON shaping."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.envelope import KIND, SEQ, TABLE
from millrace.operators import changelog, tables
from millrace.plans import sketches, splits
from millrace.session import scratch_dir, written
from millrace.sinks.files import write_files
from millrace.sources import documents, files, generate, markdown
from millrace.sources.tables import scan_many, scan_tables
from millrace.streaming.scan import scan_stream
from millrace.streaming.sinks import run_to_end, stream_to_files
from workloads.registry import query, table


@query("scan_parquet", "SELECT * FROM lineitem")
def scan_parquet(spark: SparkSession, sf: str) -> DataFrame:
    return files.scan_file(spark, f"{sf}/lineitem.parquet")


def _round_trip(spark, sf, name: str, fmt: str, **read_options) -> DataFrame:
    """Write a table in a format and scan it back."""
    df, path = table(spark, sf, name), scratch_dir(spark, f"{name}-{fmt}")
    write_options = {}
    if fmt == "csv":
        write_options["header"] = True
    if fmt in ("csv", "text"):
        write_options["null_format"] = "\\N"
        read_options["null_format"] = "\\N"
    write_files(df, path, fmt=fmt, **write_options)
    if fmt in ("csv", "text", "json", "xml"):
        read_options["schema"] = df.schema
    return files.scan_file(spark, path, fmt=fmt, **read_options)


@query("scan_orc_roundtrip", "SELECT * FROM orders")
def scan_orc_roundtrip(spark, sf):
    return _round_trip(spark, sf, "orders", "orc")


@query("scan_csv_roundtrip", "SELECT * FROM orders")
def scan_csv_roundtrip(spark, sf):
    return _round_trip(spark, sf, "orders", "csv", skip_header_row_number=1)


@query("scan_csv_line_breaks", "SELECT *, ' ' || source || ' ' AS blanks, '' AS nothing FROM documents")
def scan_csv_line_breaks(spark, sf):
    """Texts with line breaks and quotes, values with blanks around them, and empty ones, which are not NULL."""
    df = table(spark, sf, "documents").withColumns({"blanks": F.concat(F.lit(" "), "source", F.lit(" ")), "nothing": F.lit("")})
    path = scratch_dir(spark, "line-breaks")
    write_files(df, path, fmt="csv")
    return files.scan_file(spark, path, fmt="csv", schema=df.schema, multi_line=True)


@query("scan_text_roundtrip", "SELECT * FROM part")
def scan_text_roundtrip(spark, sf):
    return _round_trip(spark, sf, "part", "text")


@query("scan_json_roundtrip", "SELECT * FROM documents")
def scan_json_roundtrip(spark, sf):
    return _round_trip(spark, sf, "documents", "json")


@query("scan_xml_roundtrip", "SELECT * FROM customer")
def scan_xml_roundtrip(spark, sf):
    return _round_trip(spark, sf, "customer", "xml", row_tag="row")


@query(
    "scan_csv_skip_lines",
    "SELECT c_custkey, c_name, c_acctbal FROM customer",
)
def scan_csv_skip_lines(spark, sf):
    """Files that start with three lines of preamble."""
    df = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    path = scratch_dir(spark, "preamble")

    def with_preamble(batches):
        # A task writes one file, so what a task yields first heads its file.
        yield pd.DataFrame({"value": ["exported", "by task", "id,name,balance"]})
        yield from batches

    lines = df.select(F.to_csv(F.struct(*df.columns)).alias("value"))
    lines.mapInPandas(with_preamble, "value string").write.text(path)
    return files.scan_file(spark, path, fmt="csv", schema=df.schema, skip_header_row_number=3)


@query(
    "scan_binary_files",
    """SELECT sum(strlen(text) + 1) AS size_listed, sum(strlen(text) + 1) AS size_read,
              count(*) AS n_documents FROM documents""",
)
def scan_binary_files(spark, sf):
    path = scratch_dir(spark, "binary")
    # One line per document, so that lines can be counted again in the bytes.
    flat = table(spark, sf, "documents").select(F.replace("text", F.lit("\n"), F.lit("\x02")).alias("value"))
    flat.write.text(path)
    found = files.scan_file(spark, path, fmt="binary", extension="txt")
    content = F.col("content").cast("string")
    newlines = F.length(content) - F.length(F.replace(content, F.lit("\n"), F.lit("")))
    return found.agg(
        F.sum("length").cast("double").alias("size_listed"),
        F.sum(F.octet_length("content")).cast("double").alias("size_read"),
        F.sum(newlines).alias("n_documents"),
    )


@query(
    "markdown_elements",
    """WITH lines AS (
         SELECT doc_id, lang, source, unnest(string_split(text, chr(10))) AS line,
                unnest(range(1, len(string_split(text, chr(10))) + 1)) AS n FROM documents),
       kept AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS k FROM lines WHERE trim(line) <> '')
       SELECT doc_id, CAST(k + 2 AS INTEGER) AS position_index, 'Paragraph' AS element_type,
              0 AS heading_level, line AS text, 'heading_2' AS parent_id FROM kept
       UNION ALL SELECT doc_id, 1, 'Heading', 1, source, NULL FROM documents
       UNION ALL SELECT doc_id, 2, 'Heading', 2, lang, 'heading_1' FROM documents""",
)
def markdown_elements(spark, sf):
    # Documents become markdown: two headings, then every line a paragraph of its own.
    text = F.concat(
        F.lit("# "), F.col("source"), F.lit("\n## "), F.col("lang"), F.lit("\n\n"), F.replace("text", F.lit("\n"), F.lit("\n\n"))
    )
    df = table(spark, sf, "documents").select("doc_id", text.alias("text"))
    return markdown.markdown_elements(df).select(
        "doc_id", "position_index", "element_type", F.coalesce("heading_level", F.lit(0)).alias("heading_level"), "text", "parent_id"
    )


@query("read_partitions", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P')")
def read_partitions(spark, sf):
    path = scratch_dir(spark, "partitions")
    write_files(table(spark, sf, "orders"), path, partition_by=["o_orderstatus"])
    return files.scan_file(
        spark,
        path,
        read_partitions=["o_orderstatus=F", "o_orderstatus=P"],
        read_columns=["o_orderkey", "o_orderstatus"],
    )


@query("file_filter_scan", "SELECT * FROM supplier")
def file_filter_scan(spark, sf):
    schema = table(spark, sf, "supplier").schema
    return files.scan_file(spark, sf, schema=schema, extension="parquet", file_filter_pattern=r"supp[a-z]+\.parquet")


@query("read_columns", "SELECT l_orderkey, l_shipdate FROM lineitem")
def read_columns(spark, sf):
    return files.scan_file(spark, f"{sf}/lineitem.parquet", read_columns=["l_orderkey", "l_shipdate"])


@query("source_filter", "SELECT * FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 30")
def source_filter(spark, sf):
    return files.source_filter(table(spark, sf, "lineitem"), "l_returnflag = 'R' AND l_quantity > 30")


@query(
    "key_range_scan",
    """SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'""",
)
def key_range_scan(spark, sf):
    low, high = (F.lit(day).cast("timestamp_ntz") for day in ("1996-01-01", "1998-01-01"))
    return files.key_range_scan(table(spark, sf, "orders"), "o_orderdate", low, high)


@query(
    "scan_tables_regex",
    """SELECT 'customer' AS table_name, count(*) AS n_rows FROM customer
       UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'region', count(*) FROM region""",
)
def scan_tables_regex(spark, sf):
    database = f"mr_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_dir(spark, 'db')}'")
    for name in ("nation", "region", "supplier", "customer"):
        spark.sql(f"CREATE TABLE {database}.{name} USING parquet LOCATION '{sf}/{name}.parquet'")
    found = scan_tables(spark, rf"{database}\.(.*ion|cust.*)")
    out = None
    for path, df in found.items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(path.table).alias("table_name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    counts = written(out, "counts")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return counts


@query(
    "multi_table_scan",
    """SELECT 'shop.orders' AS table_path, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders
       UNION ALL SELECT 'shop.rich', count(*), CAST(sum(c_custkey) AS BIGINT) FROM customer WHERE c_acctbal > 5000
       UNION ALL SELECT 'shop.part', count(*), CAST(sum(p_partkey) AS BIGINT) FROM part""",
)
def multi_table_scan(spark, sf):
    found = scan_many(
        spark,
        [
            {"table_path": "shop.orders", "path": f"{sf}/orders.parquet", "read_columns": ["o_orderkey"]},
            {"table_path": "shop.rich", "path": f"{sf}/customer.parquet", "query": "select c_custkey from rich where c_acctbal > 5000"},
            {"table_path": "shop.part", "path": f"{sf}/part.parquet", "read_columns": ["p_partkey"]},
        ],
    )
    keyed = tables.for_tables(found, lambda df: df.toDF("k"))
    rows = tables.flatten_tables(keyed)
    return rows.groupBy(F.col(TABLE).alias("table_path")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("k").alias("key_sum")
    )


@query(
    "split_even_ranges",
    """SELECT CAST((o_orderkey - low) // ((n + 15) // 16) AS INTEGER) AS split, count(*) AS n_rows, min(o_orderkey) AS low, max(o_orderkey) AS high
       FROM orders, (SELECT count(*) AS n, min(o_orderkey) AS low FROM orders) GROUP BY 1""",
)
def split_even_ranges(spark, sf):
    orders = table(spark, sf, "orders")
    bounds = splits.plan_splits(orders, "o_orderkey", split_size=-(-orders.count() // 16))
    return (
        orders.groupBy(splits.split_number(orders, "o_orderkey", bounds).alias("split"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"))
    )


@query(
    "split_sampled_ranges",
    """SELECT count(*) AS n_rows, count(*) AS n_selected, count(DISTINCT o_orderpriority) AS n_keys, true AS cut_up FROM orders""",
)
def split_sampled_ranges(spark, sf):
    """Text keys: the planned conditions must select every row exactly once."""
    orders = table(spark, sf, "orders")
    bounds = splits.plan_splits(orders, "o_orderpriority", split_size=-(-orders.count() // 4))
    selected = None
    for condition in splits.split_predicates("o_orderpriority", bounds):
        part = F.expr(condition).cast("int")
        selected = part if selected is None else selected + part
    return orders.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.coalesce(selected, F.lit(0))).alias("n_selected"),
        F.countDistinct("o_orderpriority").alias("n_keys"),
        F.lit(len(bounds) > 1).alias("cut_up"),
    )


@query(
    "split_sketched_ranges",
    """SELECT count(*) AS n_rows, 1 AS selected_least, 1 AS selected_most, true AS even, true AS hot_key_cut FROM lineitem""",
)
def split_sketched_ranges(spark, sf):
    """A third of the rows have one part number: the planned ranges select every row once, none holds more than its share
    by more than the sketch's error, and that one part is cut by its orders."""
    keyed = table(spark, sf, "lineitem").select(F.expr("if(l_orderkey % 3 = 0, 77, l_partkey)").alias("part"), F.col("l_orderkey").alias("ordered"))
    planned, rows = 24, keyed.count()
    ranges = sketches.sketch_ranges(keyed, "part", planned, second="ordered")
    conditions = [F.coalesce(F.expr(c), F.lit(False)) for c in sketches.range_conditions(ranges, "part", "ordered")]
    counted = keyed.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(c).alias(f"s{i}") for i, c in enumerate(conditions)],
        F.min(sum(c.cast("int") for c in conditions)).alias("selected_least"),
        F.max(sum(c.cast("int") for c in conditions)).alias("selected_most"),
    )
    # A key is not cut without a second one, so a range may hold one more of those that are not hot.
    largest = keyed.where("part <> 77").groupBy("part").count().agg(F.max("count")).first()[0]
    share = rows / planned * 1.15 + 2 * sketches.rank_error() * rows + largest
    most = F.greatest(*[F.col(f"s{i}") for i in range(len(conditions))])
    cut = sum(r.of_one_key for r in ranges) >= planned // 4
    return counted.select("n_rows", "selected_least", "selected_most", (most <= share).alias("even"), F.lit(cut).alias("hot_key_cut"))


@query(
    "incremental_between",
    """SELECT '-D' AS kind, c_custkey, c_acctbal FROM customer WHERE c_mktsegment = 'HOUSEHOLD'
       UNION ALL SELECT '+I', c_custkey, c_acctbal FROM customer WHERE c_mktsegment = 'MACHINERY'
       UNION ALL SELECT '-U', c_custkey, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'
       UNION ALL SELECT '+U', c_custkey, c_acctbal + 1 FROM customer WHERE c_mktsegment = 'BUILDING'""",
)
def incremental_between(spark, sf):
    customer = table(spark, sf, "customer")
    old = customer.where("c_mktsegment <> 'MACHINERY'")
    new = customer.where("c_mktsegment <> 'HOUSEHOLD'").withColumn(
        "c_acctbal", F.expr("if(c_mktsegment = 'BUILDING', c_acctbal + 1, c_acctbal)")
    )
    changes = changelog.changes_between(old, new, keys=["c_custkey"])
    return changes.select(F.col(KIND).alias("kind"), "c_custkey", "c_acctbal")


@query(
    "cdc_initial_load",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
       FROM orders WHERE o_orderstatus <> 'F'""",
)
def cdc_initial_load(spark, sf):
    orders = table(spark, sf, "orders")
    snapshot = orders.select("o_orderkey", "o_totalprice")
    changes = orders.where("o_orderstatus <> 'O'").select(
        "o_orderkey",
        F.expr("if(o_orderstatus = 'P', o_totalprice + 1, o_totalprice)").alias("o_totalprice"),
        F.expr("if(o_orderstatus = 'P', '+U', '-D')").alias(KIND),
        (F.col("o_orderkey") + 1).alias(SEQ),
    )
    log = changelog.snapshot_then_changes(snapshot, changes, startup_mode="initial")
    return changelog.fold_changelog(log, keys=["o_orderkey"])


@query(
    "generate_rows",
    "SELECT count(*) AS n_rows, count(*) AS in_range, count(*) AS from_pool, count(*) AS right_sizes FROM orders",
)
def generate_rows(spark, sf):
    """One generated row per order id; the ranges, pools and sizes asked for must hold in every row."""
    made = generate.generate_columns(
        table(spark, sf, "orders"),
        id_col="o_orderkey",
        schema={
            "c_int": "int",
            "c_double": "double",
            "c_string": "string",
            "c_array": "array<int>",
            "c_map": "map<string, bigint>",
            "c_bytes": "bytes",
            "c_decimal": "decimal(10,2)",
            "c_date": "date",
            "c_timestamp": "timestamp",
            "c_row": {"a": "smallint", "b": "boolean"},
            "c_vector": "float_vector",
        },
        int__min=10,
        int__max=19,
        double__min=-1,
        double__max=1,
        string__template=["red", "green"],
        array__size=3,
        map__size=2,
        bytes__length=7,
        c_vector__size=4,
    )
    in_range = F.expr("c_int BETWEEN 10 AND 19 AND c_double BETWEEN -1 AND 1 AND c_date IS NOT NULL AND c_row.a >= 0")
    sizes = F.expr("size(c_array) = 3 AND size(c_map) = 2 AND octet_length(c_bytes) = 7 AND size(c_vector) = 4")
    return made.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(in_range).alias("in_range"),
        F.count_if(F.col("c_string").isin("red", "green")).alias("from_pool"),
        F.count_if(sizes & F.expr("c_decimal < 100000000 AND c_timestamp IS NOT NULL")).alias("right_sizes"),
    )


@query("generate_auto_increment", "SELECT CAST(100 + row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS id FROM orders")
def generate_auto_increment(spark, sf):
    """As many rows as there are orders, numbered from 100 over all readers."""
    n = table(spark, sf, "orders").count()
    return generate.generate(spark, schema={"id": "bigint"}, row_num=n, auto_increment={"id": 100})


@query(
    "literal_changelog",
    """SELECT n_nationkey, CASE n_nationkey WHEN 3 THEN 'RENAMED' ELSE n_name END AS n_name, count(c_custkey) AS n_customers
       FROM (SELECT n_nationkey, n_name FROM nation WHERE n_nationkey <> 5 UNION ALL SELECT 99, 'NEWLAND') n
       LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2""",
)
def literal_changelog(spark, sf):
    """Changes written out in the job, applied to the nations and counted against the customers."""
    changes = generate.literal_rows(
        spark,
        schema={"n_nationkey": "int", "n_name": "string"},
        rows=[("+I", (99, "NEWLAND")), ("-U", (3, "NATION_3")), ("+U", (3, "RENAMED")), ("DELETE", (5, "NATION_5"))],
    )
    nations = changelog.apply_changelog(
        table(spark, sf, "nation").select("n_nationkey", "n_name"), changes, keys=["n_nationkey"]
    )
    # Customers are counted per nation before the join.
    counts = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    joined = nations.join(counts, nations["n_nationkey"] == counts["c_nationkey"], "left")
    return joined.select("n_nationkey", "n_name", F.coalesce("n", F.lit(0)).alias("n_customers"))


@query(
    "bounded_stream_scan",
    """SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20'""",
)
def bounded_stream_scan(spark, sf):
    schema = table(spark, sf, "events").schema
    stream = scan_stream(
        spark,
        f"{sf}/events.parquet*",  # a pattern, so that one file does as well as a folder
        schema=schema,
        event_time="ts",
        start_mode="TIMESTAMP",
        start_timestamp="2024-01-05",
        stop_mode="TIMESTAMP",
        stop_timestamp="2024-01-20",
    )
    out = scratch_dir(spark, "bounded")
    run_to_end(stream_to_files(stream, out, scratch_dir(spark, "checkpoint")))
    return spark.read.schema(schema).parquet(out)


@query("rate_limited_stream", "SELECT * FROM customer")
def rate_limited_stream(spark, sf):
    """A capped stream reads everything, only in more batches."""
    source, out = scratch_dir(spark, "slow-in"), scratch_dir(spark, "slow-out")
    customer = table(spark, sf, "customer")
    customer.write.partitionBy("c_mktsegment").parquet(source)
    sizes = files.scan_file(spark, source, fmt="binary", extension="parquet").agg(F.sum("length")).first()[0]
    stream = scan_stream(spark, source, schema=customer.schema, bytes_per_second=max(1, sizes // 4))
    finished = run_to_end(stream_to_files(stream, out, scratch_dir(spark, "checkpoint")))
    assert finished.lastProgress["batchId"] >= 2
    return spark.read.schema(customer.schema).parquet(out)


# One JSON document per order, with an array of objects in it.
_ORDER_DOCUMENT = """to_json(named_struct('store', named_struct('book', array(
    named_struct('kind', 'id', 'n', o_orderkey), named_struct('kind', 'customer', 'n', o_custkey)))))"""


@query(
    "json_document_rows",
    """SELECT o_orderkey, 'id' AS kind, o_orderkey AS n FROM orders
       UNION ALL SELECT o_orderkey, 'customer', o_custkey FROM orders""",
)
def json_document_rows(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", F.expr(_ORDER_DOCUMENT).alias("body"))
    return documents.json_document_rows(
        df, column="body", content_field="$.store.book.*", schema={"kind": "string", "n": "bigint"}
    )


@query(
    "json_document_columns",
    """SELECT o_orderkey, 'id' AS kind, o_orderkey AS n FROM orders
       UNION ALL SELECT o_orderkey, 'customer', o_custkey FROM orders""",
)
def json_document_columns(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", F.expr(_ORDER_DOCUMENT).alias("body"))
    return documents.json_document_rows(
        df,
        column="body",
        json_field={"kind": "$.store.book[*].kind", "n": "$.store.book[*].n"},
        types={"n": "bigint"},
    )


_HASH = "map('seg', to_json(named_struct('name', c_mktsegment, 'n', 1)), 'nat', to_json(named_struct('name', c_name, 'n', c_nationkey)))"


@query(
    "hash_rows_kv",
    """SELECT c_custkey, 'seg' AS hash_key, c_mktsegment AS name, 1 AS n FROM customer
       UNION ALL SELECT c_custkey, 'nat', c_name, c_nationkey FROM customer""",
)
def hash_rows_kv(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", F.expr(_HASH).alias("entries"))
    return documents.hash_rows(
        df, map_col="entries", mode="kv", schema={"hash_key": "string", "name": "string", "n": "int"}
    )


@query("hash_rows_all", "SELECT c_custkey, c_mktsegment AS seg_name, c_nationkey AS nat_n FROM customer")
def hash_rows_all(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", F.expr(_HASH).alias("entries"))
    member = {"name": "string", "n": "int"}
    rows = documents.hash_rows(df, map_col="entries", mode="all", schema={"seg": member, "nat": member})
    return rows.select("c_custkey", F.col("seg.name").alias("seg_name"), F.col("nat.n").alias("nat_n"))
