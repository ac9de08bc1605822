"""Projections, renames, row kinds, JSON paths, validation, user code and the SQL transform."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.envelope import DELAY_MS, EVENT_MS, KIND, PARTITION, TABLE, TableSet
from millrace.operators import fields, jsonpath, models, rowkind, tables, validate as checks
from millrace.operators.sql import sql
from workloads.registry import query, table


@query("copy_fields", "SELECT *, o_orderstatus AS status_copy, o_totalprice AS price_copy FROM orders")
def copy_fields(spark: SparkSession, sf: str) -> DataFrame:
    return fields.copy_fields(
        table(spark, sf, "orders"), fields={"status_copy": "o_orderstatus", "price_copy": "o_totalprice"}
    )


@query("field_mapper", "SELECT c_name AS name, c_custkey AS id FROM customer")
def field_mapper(spark, sf):
    return fields.field_mapper(table(spark, sf, "customer"), mapping={"c_name": "name", "c_custkey": "id"})


@query("filter_fields_include", "SELECT p_partkey, p_brand FROM part")
def filter_fields_include(spark, sf):
    return fields.filter_fields(table(spark, sf, "part"), include=["p_partkey", "p_brand"])


@query("filter_fields_exclude", "SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem")
def filter_fields_exclude(spark, sf):
    gone = [
        "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    ]
    return fields.filter_fields(table(spark, sf, "lineitem"), exclude=gone)


@query(
    "rename_fields",
    """SELECT o_orderkey AS id, o_custkey AS F_CUSTKEY_S, o_orderstatus AS F_ORDERSTATUS_S,
              o_totalprice AS F_TOTALPRICE_S, o_orderdate AS F_DAY_S, o_orderpriority AS F_ORDERPRIORITY_S
       FROM orders""",
)
def rename_fields(spark, sf):
    return fields.rename_fields(
        table(spark, sf, "orders"),
        convert_case="UPPER",
        prefix="F_",
        suffix="_S",
        replacements_with_regex=[
            {"replace_from": "o_orderdate", "replace_to": "day", "is_regex": False},
            {"replace_from": "^o_(.*)", "replace_to": "$1"},
        ],
        specific=[{"field_name": "o_orderkey", "target_name": "id"}],
    )


def _small_tables(spark, sf) -> TableSet:
    return TableSet.of(
        {f"shop.{name}": table(spark, sf, name) for name in ("nation", "region", "supplier", "customer", "part")}
    )


def _counts(tables_: TableSet) -> DataFrame:
    """One row per table: its path, row count and the sum of its key, the first column."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(df.columns[0]).alias("key_sum")).select(
            F.lit(str(path)).alias("table_path"), "n_rows", "key_sum"
        )
        for path, df in tables_.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "rename_table",
    """SELECT 'shop.ODS_NATIONS' AS table_path, count(*) AS n_rows, sum(n_nationkey)::BIGINT AS key_sum FROM nation
       UNION ALL SELECT 'shop.ODS_REGION', count(*), sum(r_regionkey)::BIGINT FROM region
       UNION ALL SELECT 'shop.ODS_SUPPLIER', count(*), sum(s_suppkey)::BIGINT FROM supplier
       UNION ALL SELECT 'shop.ODS_CUSTOMER', count(*), sum(c_custkey)::BIGINT FROM customer
       UNION ALL SELECT 'shop.ODS_PART', count(*), sum(p_partkey)::BIGINT FROM part""",
)
def rename_table(spark, sf):
    return _counts(
        tables.rename_table(
            _small_tables(spark, sf),
            convert_case="UPPER",
            prefix="ODS_",
            replacements_with_regex=[{"replace_from": "^nation$", "replace_to": "nations"}],
        )
    )


@query(
    "filter_tables",
    """SELECT 'shop.nation' AS table_path, count(*) AS n_rows, sum(n_nationkey)::BIGINT AS key_sum FROM nation
       UNION ALL SELECT 'shop.region', count(*), sum(r_regionkey)::BIGINT FROM region""",
)
def filter_tables(spark, sf):
    return _counts(tables.filter_tables(_small_tables(spark, sf), database_pattern="shop", table_pattern=".*ion"))


def _order_shards(spark, sf) -> TableSet:
    orders = table(spark, sf, "orders")
    return TableSet.of(
        {f"source.orders_{status}": orders.where(F.col("o_orderstatus") == status) for status in ("F", "O", "P")}
    )


@query("merge_tables", "SELECT *, 'dw.orders' AS table_path FROM orders")
def merge_tables(spark, sf):
    merged = tables.merge_tables(_order_shards(spark, sf), database="dw", table="orders")
    return tables.flatten_tables(merged).withColumnRenamed(TABLE, "table_path")


@query(
    "sharding_mode",
    "SELECT o_orderstatus, count(*) AS n_rows, 'orders_all' AS table_path FROM orders GROUP BY 1",
)
def sharding_mode(spark, sf):
    one = tables.shard_mode(_order_shards(spark, sf), mode="SHARDING", table="orders_all")
    rows = tables.flatten_tables(one)
    return rows.groupBy("o_orderstatus", F.col(TABLE).alias("table_path")).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "multi_table_transform",
    """SELECT o_orderkey, o_orderstatus AS name1, NULL AS name2, 'source.orders_F' AS table_path FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT o_orderkey, NULL, o_orderpriority, 'source.orders_O' FROM orders WHERE o_orderstatus = 'O'
       UNION ALL SELECT o_orderkey, NULL, NULL, 'source.orders_P' FROM orders WHERE o_orderstatus = 'P'""",
)
def multi_table_transform(spark, sf):
    done = tables.for_tables(
        _order_shards(spark, sf),
        lambda df: fields.copy_fields(df, fields={"name1": "o_orderstatus"}),
        table_match_regex=r"source\.orders_[FO]",
        table_transform={"source.orders_O": lambda df: fields.copy_fields(df, fields={"name2": "o_orderpriority"})},
    )
    out = None
    for path, df in done.items():
        rows = df.withColumn("table_path", F.lit(str(path)))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out.select("o_orderkey", "name1", "name2", "table_path")


@query("replace_literal", "SELECT c_custkey, replace(c_name, '#0', '-') AS c_name FROM customer")
def replace_literal(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_name")
    return fields.replace(df, field="c_name", pattern="#0", replacement="-")


@query(
    "replace_regex",
    r"SELECT doc_id, regexp_replace(text, '([a-z])([A-Z])', '\2\1', 'g') AS text FROM documents",
)
def replace_regex(spark, sf):
    df = table(spark, sf, "documents").select("doc_id", "text")
    return fields.replace(df, field="text", pattern="([a-z])([A-Z])", replacement="$2$1", is_regex=True)


@query("replace_first", r"SELECT doc_id, regexp_replace(text, '([a-z])([a-z]) ', '\2\1 ') AS text FROM documents")
def replace_first(spark, sf):
    df = table(spark, sf, "documents").select("doc_id", "text")
    return fields.replace(
        df, field="text", pattern="([a-z])([a-z]) ", replacement="$2$1 ", is_regex=True, replace_first=True
    )


@query(
    "split_field",
    """SELECT o_orderkey, o_orderpriority, split_part(o_orderpriority, '-', 1) AS level,
              CASE WHEN contains(o_orderpriority, '-')
                   THEN substr(o_orderpriority, strpos(o_orderpriority, '-') + 1) END AS label,
              CAST(NULL AS VARCHAR) AS rest
       FROM orders""",
)
def split_field(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return fields.split_field(df, field="o_orderpriority", separator="-", output_fields=["level", "label", "rest"])


@query(
    "regex_extract",
    r"""SELECT page_id,
               CASE WHEN regexp_matches(url, '^https?://([^/]+)/([a-z]{2})/(\d+)') THEN regexp_extract(url, '^https?://([^/]+)/([a-z]{2})/(\d+)', 1) ELSE 'unknown' END AS host,
               CASE WHEN regexp_matches(url, '^https?://([^/]+)/([a-z]{2})/(\d+)') THEN regexp_extract(url, '^https?://([^/]+)/([a-z]{2})/(\d+)', 2) ELSE '??' END AS lang,
               CASE WHEN regexp_matches(url, '^https?://([^/]+)/([a-z]{2})/(\d+)') THEN regexp_extract(url, '^https?://([^/]+)/([a-z]{2})/(\d+)', 3) ELSE NULL END AS number
        FROM pages""",
)
def regex_extract(spark, sf):
    df = table(spark, sf, "pages").select("page_id", "url")
    return fields.regex_extract(
        df,
        field="url",
        pattern=r"^https?://([^/]+)/([a-z]{2})/(\d+)",
        output_fields=["host", "lang", "number"],
        default_values=["unknown", "??", None],
    ).drop("url")


@query(
    "json_path",
    """SELECT event_id, props, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
              json_extract_string(props, '$.k') AS k_text, json_extract_string(props, '$.z') IS NULL AS absent
       FROM events""",
)
def json_path(spark, sf):
    return jsonpath.json_path(
        table(spark, sf, "events").select("event_id", "props"),
        columns=[
            {"src_field": "props", "path": ["$.k", "$['k']"], "dest_field": ["k", "k_text"], "dest_type": ["int", "string"]},
            {"src_field": "props", "path": "$.z", "dest_field": "absent", "dest_type": "bigint", "column_error_handle_way": "SKIP"},
        ],
    ).withColumn("absent", F.col("absent").isNull())


# A list of none, one or two objects for each order.
_LISTS = """concat('{"l":[', CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN concat('{"k":', o_custkey, '}')
            ELSE concat('{"k":', o_custkey, '},{"k":', o_orderkey, '}') END, ']}')"""


@query(
    "json_path_wildcard",
    """SELECT o_orderkey, ks, ks AS ks_text_list, len(ks) = 0 AS none FROM (
         SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN []::BIGINT[] WHEN 1 THEN [o_custkey::BIGINT]
                ELSE [o_custkey::BIGINT, o_orderkey::BIGINT] END AS ks FROM orders)""",
)
def json_path_wildcard(spark, sf):
    """None, one and many matches of a wildcard, under both ways to handle errors."""
    df = table(spark, sf, "orders").select("o_orderkey", F.expr(_LISTS).alias("doc"))
    column = {"src_field": "doc", "path": "$.l[*].k", "dest_type": "array<bigint>"}
    read = jsonpath.json_path(
        df,
        columns=[
            {**column, "dest_field": "ks", "column_error_handle_way": "FAIL"},
            {**column, "dest_field": "ks_text_list", "column_error_handle_way": "SKIP"},
        ],
    )
    return read.drop("doc").withColumn("none", F.size("ks") == 0)


@query(
    "json_path_skip_row",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS TINYINT) AS k
       FROM events WHERE event_type <> 'error'""",
)
def json_path_skip_row(spark, sf):
    # Error events get a document that is cut off, so every one of them is malformed.
    df = table(spark, sf, "events").select(
        "event_id", F.expr("CASE WHEN event_type = 'error' THEN left(props, 4) ELSE props END").alias("props")
    )
    return jsonpath.json_path(
        df,
        columns=[{"src_field": "props", "path": "$.k", "dest_field": "k", "dest_type": "tinyint"}],
        row_error_handle_way="SKIP",
    ).drop("props")


@query(
    "json_path_row",
    "SELECT c_custkey, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation FROM customer",
)
def json_path_row(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", F.struct("c_name", "c_nationkey").alias("col"))
    return jsonpath.json_path(
        df,
        columns=[
            {"src_field": "col", "path": "$[0]", "dest_field": "name"},
            {"src_field": "col", "path": "$[1]", "dest_field": "nation", "dest_type": "bigint"},
        ],
    ).drop("col")


# Row kinds that follow the order status, so SQL can state them too.
KIND_SQL = "CASE o_orderstatus WHEN 'F' THEN '-D' WHEN 'P' THEN '+U' ELSE '+I' END"


def orders_with_kind(spark, sf) -> DataFrame:
    return rowkind.with_kind(table(spark, sf, "orders"), F.expr(KIND_SQL))


@query(
    "add_metadata",
    f"""SELECT o_orderkey, 'shop' AS source_db, 'orders' AS source_table, {KIND_SQL} AS op_type,
               epoch_us(o_orderdate) // 1000 AS event_ts, CAST(5 AS BIGINT) AS sync_delay,
               o_orderstatus || ',' || o_orderpriority AS partition_info
        FROM orders""",
)
def add_metadata(spark, sf):
    df = rowkind.event_time_and_delay(orders_with_kind(spark, sf), ts_col="o_orderdate").withColumns(
        {
            TABLE: F.lit("shop.orders"),
            PARTITION: F.array("o_orderstatus", "o_orderpriority"),
            DELAY_MS: F.lit(5).cast("bigint"),
        }
    )
    names = {
        "Database": "source_db",
        "Table": "source_table",
        "RowKind": "op_type",
        "EventTime": "event_ts",
        "Delay": "sync_delay",
        "Partition": "partition_info",
    }
    return rowkind.add_metadata(df, metadata_fields=names).select("o_orderkey", *names.values())


@query("filter_row_kind", f"SELECT *, {KIND_SQL} AS kind FROM orders WHERE o_orderstatus <> 'F'")
def filter_row_kind(spark, sf):
    return rowkind.filter_row_kind(orders_with_kind(spark, sf), exclude=["DELETE"]).withColumnRenamed(KIND, "kind")


@query(
    "extract_row_kind",
    """SELECT *, '+I' AS kind,
              CASE o_orderstatus WHEN 'F' THEN 'DELETE' WHEN 'P' THEN 'UPDATE_AFTER' ELSE 'INSERT' END AS row_kind
       FROM orders""",
)
def extract_row_kind(spark, sf):
    return rowkind.extract_row_kind(orders_with_kind(spark, sf), transform_type="FULL").withColumnRenamed(KIND, "kind")


@query(
    "event_delay",
    """SELECT event_id, epoch_us(ts) // 1000 AS event_ms,
              1735689600000 - epoch_us(ts) // 1000 AS delay_ms FROM events""",
)
def event_delay(spark, sf):
    df = table(spark, sf, "events").select("event_id", "ts")
    done = rowkind.event_time_and_delay(df, ts_col="ts", extracted_at_ms=F.lit(1735689600000))
    return done.select("event_id", F.col(EVENT_MS).alias("event_ms"), F.col(DELAY_MS).alias("delay_ms"))


_LABEL_RULES = [
    {"field_name": "quality", "rules": [{"rule_type": "NOT_NULL"}, {"rule_type": "RANGE", "min_value": 1}]},
    {"field_name": "toxic", "rule_type": "RANGE", "max_value": 1, "max_inclusive": False},
]


@query("validate_skip", "SELECT * FROM labels WHERE quality >= 1 AND toxic < 1")
def validate_skip(spark, sf):
    return checks.validate(table(spark, sf, "labels"), field_rules=_LABEL_RULES, row_error_handle_way="SKIP")


@query(
    "validate_route",
    """SELECT 'db.labels' AS source_table_id, 'db.labels' AS source_table_path,
              '{"doc_id":' || doc_id || ',"quality":' || quality || ',"toxic":' || toxic || '}' AS original_data,
              '[' || concat_ws(',',
                 CASE WHEN NOT quality >= 1 THEN '{"field_name":"quality","error_message":"Field ''quality'' value ' || quality || ' is not within range [1, +inf)"}' END,
                 CASE WHEN NOT toxic < 1 THEN '{"field_name":"toxic","error_message":"Field ''toxic'' value ' || toxic || ' is not within range (-inf, 1)"}' END) || ']' AS validation_errors
       FROM labels WHERE NOT (quality >= 1 AND toxic < 1)""",
)
def validate_route(spark, sf):
    routed = checks.validate_route(table(spark, sf, "labels"), field_rules=_LABEL_RULES, table="db.labels")
    return routed.errors.drop("create_time")


@query(
    "validate_route_once",
    """SELECT doc_id, 'valid' AS route, CAST(0 AS INTEGER) AS n_errors FROM labels WHERE quality >= 1 AND toxic < 1
       UNION ALL SELECT doc_id, 'rejected', CAST((NOT quality >= 1)::INTEGER + (NOT toxic < 1)::INTEGER AS INTEGER)
       FROM labels WHERE NOT (quality >= 1 AND toxic < 1)""",
)
def validate_route_once(spark, sf):
    """Both tables from one pass over the input."""
    routed = checks.validate_route(table(spark, sf, "labels"), field_rules=_LABEL_RULES, table="db.labels", read_once=True)
    valid = routed.valid.select("doc_id", F.lit("valid").alias("route"), F.lit(0).alias("n_errors"))
    number = F.get_json_object("original_data", "$.doc_id").cast("bigint")
    many = F.json_array_length("validation_errors").cast("int")
    return valid.unionByName(routed.errors.select(number.alias("doc_id"), F.lit("rejected").alias("route"), many.alias("n_errors")))


@query(
    "sql_carry_envelope_comments",
    """SELECT o_orderkey AS id, '+U' AS kind FROM orders WHERE o_orderstatus = 'F'""",
)
def sql_carry_envelope_comments(spark, sf):
    """Comments before the query and inside it, some of which hold the word select."""
    rows = table(spark, sf, "orders").withColumn(KIND, F.lit("+U"))
    query_text = """-- select nothing
        /* select all /* and select */ more */ SELECT /* select */ o_orderkey AS id FROM dual WHERE o_orderstatus = 'F'"""
    return sql(rows, query_text, carry_envelope=True).withColumnRenamed(KIND, "kind")


@query("validate_range", "SELECT * FROM lineitem WHERE l_quantity >= 5 AND l_quantity <= 45 AND l_discount < 0.08")
def validate_range(spark, sf):
    rules = [
        {"field_name": "l_quantity", "rule_type": "RANGE", "min_value": 5, "max_value": 45},
        {"field_name": "l_discount", "rule_type": "RANGE", "max_value": 0.08, "max_inclusive": False},
    ]
    return checks.validate(table(spark, sf, "lineitem"), field_rules=rules, row_error_handle_way="SKIP")


@query(
    "validate_length",
    "SELECT doc_id, text, lang FROM documents WHERE length(text) BETWEEN 200 AND 20000 AND length(lang) = 2",
)
def validate_length(spark, sf):
    rules = [
        {"field_name": "text", "rule_type": "LENGTH", "min_length": 200, "max_length": 20000},
        {"field_name": "lang", "rule_type": "LENGTH", "exact_length": 2},
    ]
    df = table(spark, sf, "documents").select("doc_id", "text", "lang")
    return checks.validate(df, field_rules=rules, row_error_handle_way="SKIP")


@query("validate_regex", "SELECT doc_id, text FROM documents WHERE regexp_matches(text, '(?i)and the')")
def validate_regex(spark, sf):
    rules = [{"field_name": "text", "rule_type": "REGEX", "pattern": "AND THE", "case_sensitive": False}]
    df = table(spark, sf, "documents").select("doc_id", "text")
    return checks.validate(df, field_rules=rules, row_error_handle_way="SKIP")


@query(
    "validate_email",
    """SELECT c_custkey, lower(replace(c_name, '#', '.')) || '@example.com' AS email
       FROM customer WHERE c_mktsegment <> 'BUILDING'""",
)
def validate_email(spark, sf):
    # One market segment gets addresses with a character the check refuses.
    df = table(spark, sf, "customer").select(
        "c_custkey",
        F.expr(
            "concat(lower(if(c_mktsegment = 'BUILDING', c_name, replace(c_name, '#', '.'))), '@example.com')"
        ).alias("email"),
    )
    rules = [{"field_name": "email", "rule_type": "UDF", "function_name": "EMAIL"}]
    return checks.validate(df, field_rules=rules, row_error_handle_way="SKIP")


@query(
    "infer_column_local",
    "SELECT conv_id, turn, CAST(len(string_split(text, ' ')) AS INTEGER) AS n_words FROM conversations",
)
def infer_column_local(spark, sf):
    def count_words(prompt: str, rows: pd.DataFrame) -> list[str]:
        return [str(text.count(" ") + 1) for text in rows["text"]]

    df = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    answered = models.infer_column(
        df,
        prompt="How many words?",
        model_fn=count_words,
        inference_columns=["text"],
        output_column="n_words",
        output_type="INT",
    )
    return answered.drop("text")


@query(
    "embed_columns_local",
    """SELECT item_id, CAST(length(text) AS INTEGER) AS e0,
              CAST(length(text) - length(replace(text, 'e', '')) AS INTEGER) AS e1 FROM benchmark""",
)
def embed_columns_local(spark, sf):
    def embed(texts: pd.Series) -> list[list[float]]:
        return [[float(len(text)), float(text.count("e"))] for text in texts]

    df = models.embed_columns(
        table(spark, sf, "benchmark"), vectorization_fields={"text_vector": "text"}, model_fn=embed
    )
    return df.select("item_id", *[F.col("text_vector")[i].cast("int").alias(f"e{i}") for i in (0, 1)])


@query(
    "custom_rows",
    """SELECT o_orderkey, substr(o_orderpriority, 1, 1) AS o_orderpriority,
              CAST(floor(o_totalprice / 1000) AS BIGINT) AS price_band FROM orders""",
)
def custom_rows(spark, sf):
    def band(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "price_band": (rows["o_totalprice"] // 1000).astype("int64"),
                "o_orderpriority": rows["o_orderpriority"].str[:1],
            }
        )

    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    return models.custom_rows(df, band, out_columns={"price_band": "bigint", "o_orderpriority": "string"}).drop(
        "o_totalprice"
    )


@query(
    "define_sink_type",
    """SELECT 'c_custkey' AS col_name, 'decimal(20,0)' AS data_type, count(*) AS n_rows FROM customer
       UNION ALL SELECT 'c_name', 'varchar(40)', count(*) FROM customer""",
)
def define_sink_type(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_name")
    typed = rowkind.define_sink_type(
        df,
        columns=[{"column": "c_custkey", "type": "decimal(20,0)"}, {"column": "c_name", "type": "varchar(40)"}],
    )
    declared = rowkind.sink_types(typed)
    counts = typed.select([F.count(name).alias(name) for name in declared])
    rows = [
        F.struct(F.lit(n).alias("col_name"), F.lit(t).alias("data_type"), F.col(n).alias("n_rows"))
        for n, t in declared.items()
    ]
    return counts.select(F.inline(F.array(*rows)))


@query(
    "sql_project_filter",
    """SELECT o_orderkey AS id, o_orderstatus || '_' AS status, o_custkey + 1 AS cust, o_totalprice
       FROM orders WHERE o_totalprice > 100000""",
)
def sql_project_filter(spark, sf):
    return sql(
        table(spark, sf, "orders"),
        """select o_orderkey as id, concat(o_orderstatus, '_') as status, o_custkey + 1 as cust, o_totalprice
           from dual where o_totalprice > 100000""",
    )


@query(
    "sql_nested_path",
    "SELECT c_custkey, c_name AS inner_name, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS missing FROM customer",
)
def sql_nested_path(spark, sf):
    df = table(spark, sf, "customer").select(
        "c_custkey",
        F.struct(
            F.struct("c_name", F.create_map(F.lit("seg"), F.col("c_mktsegment")).alias("c_map")).alias("c_inner")
        ).alias("c_row"),
    )
    return sql(
        df,
        """select c_custkey, c_row.c_inner.c_name as inner_name, c_row.c_inner.c_map.seg as segment,
                  c_row.c_inner.c_map.nothing as missing from dual""",
    )


@query(
    "sql_lateral_explode",
    "SELECT o_orderkey, unnest(string_split(o_orderpriority, '-')) AS part FROM orders",
)
def sql_lateral_explode(spark, sf):
    return sql(
        table(spark, sf, "orders"),
        "select o_orderkey, part from dual lateral view explode(split(o_orderpriority, '-')) t as part",
    )


@query(
    "sql_carry_kind",
    f"SELECT o_orderkey AS id, o_totalprice * 2 AS twice, {KIND_SQL} AS kind FROM orders WHERE o_custkey > 10",
)
def sql_carry_kind(spark, sf):
    done = sql(
        orders_with_kind(spark, sf),
        "select o_orderkey as id, o_totalprice * 2 as twice from dual where o_custkey > 10",
        carry_envelope=True,
    )
    return done.withColumnRenamed(KIND, "kind")


@query("sql_udf", "SELECT c_custkey, reverse(c_name) AS back FROM customer")
def sql_udf(spark, sf):
    @F.pandas_udf("string")
    def turn_around(text: pd.Series) -> pd.Series:
        return text.str[::-1]

    return sql(
        table(spark, sf, "customer"),
        "select c_custkey, turn_around(c_name) as back from dual",
        functions={"turn_around": turn_around},
    )
