"""Changelogs: message formats, folding, applying, schema evolution, streams, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from millrace.envelope import EVENT_MS, KIND, SEQ, TABLE, TableSet
from millrace.operators import changelog, evolve, messages
from millrace.schema import schema_from_fields
from millrace.session import scratch_dir
from millrace.sinks.files import write_files
from millrace.sinks.keyed import KeyedTable
from millrace.streaming.evolution import EvolvingTable, event_message
from millrace.streaming.fold import stream_fold
from millrace.streaming.handover import drain, scan_snapshot_then_changes
from millrace.streaming.metrics import job_counts
from millrace.streaming.scan import scan_stream
from millrace.streaming.sinks import (
    run_to_end,
    stream_apply_changelog,
    stream_for_each,
    stream_route_changelog,
    stream_to_files,
)
from workloads.registry import query, table

CUSTOMER = {"c_custkey": "bigint", "c_name": "string", "c_acctbal": "double"}
_ROW = "named_struct('c_custkey', c_custkey, 'c_name', c_name, 'c_acctbal', c_acctbal)"
_OLD = "named_struct('c_custkey', c_custkey, 'c_name', c_name, 'c_acctbal', c_acctbal - 1)"
_NULL_ROW = f"if(false, {_ROW}, null)"

# Market segments stand for what happened to a customer: deleted, updated, or inserted.
DECODED_SQL = """
    SELECT c_custkey, c_name, c_acctbal, '-D' AS kind, 'shop.customer' AS table_path, CAST(1700000000000 AS BIGINT) AS event_ms
    FROM customer WHERE c_mktsegment = 'BUILDING'
    UNION ALL SELECT c_custkey, c_name, c_acctbal - 1, '-U', 'shop.customer', 1700000000000 FROM customer WHERE c_mktsegment = 'MACHINERY'
    UNION ALL SELECT c_custkey, c_name, c_acctbal, '+U', 'shop.customer', 1700000000000 FROM customer WHERE c_mktsegment = 'MACHINERY'
    UNION ALL SELECT c_custkey, c_name, c_acctbal, '+I', 'shop.customer', 1700000000000 FROM customer
      WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')"""


def _kinds(deleted: str, updated: str, inserted: str) -> str:
    return f"CASE c_mktsegment WHEN 'BUILDING' THEN '{deleted}' WHEN 'MACHINERY' THEN '{updated}' ELSE '{inserted}' END"


def _shown(df: DataFrame) -> DataFrame:
    return df.select(
        "c_custkey", "c_name", "c_acctbal", F.col(KIND).alias("kind"), F.col(TABLE).alias("table_path"), F.col(EVENT_MS).alias("event_ms")
    )


def _messages(spark: SparkSession, sf: str, *fields: str) -> DataFrame:
    body = f"to_json(named_struct({', '.join(fields)}), map('ignoreNullFields', 'false'))"
    return table(spark, sf, "customer").select(F.expr(body).cast("binary").alias("value"))


def debezium_messages(spark, sf, *more: str) -> DataFrame:
    before = f"if(c_mktsegment = 'BUILDING', {_ROW}, if(c_mktsegment = 'MACHINERY', {_OLD}, {_NULL_ROW}))"
    after = f"if(c_mktsegment = 'BUILDING', {_NULL_ROW}, {_ROW})"
    return _messages(
        spark, sf, "'before'", before, "'after'", after, "'op'", _kinds("d", "u", "c"),
        "'source'", "named_struct('db', 'shop', 'table', 'customer', 'ts_ms', 1700000000000)", *more,
    )


@query("decode_debezium", DECODED_SQL)
def decode_debezium(spark, sf):
    return _shown(messages.decode_debezium(debezium_messages(spark, sf), schema=CUSTOMER))


@query("decode_debezium_bad_types", DECODED_SQL)
def decode_debezium_bad_types(spark, sf):
    """Every message is followed by a copy with a key that is no number: with errors ignored its key is NULL."""
    good = debezium_messages(spark, sf).select(F.col("value").cast("string").alias("value"))
    bad = good.select(F.expr("regexp_replace(value, '\"c_custkey\":(\\\\d+)', '\"c_custkey\":\"no $1\"')").alias("value"))
    decoded = messages.decode_debezium(good.unionByName(bad), schema=CUSTOMER, ignore_errors=True)
    return _shown(decoded.where("c_custkey IS NOT NULL"))


@query("decode_debezium_with_schema", DECODED_SQL)
def decode_debezium_with_schema(spark, sf):
    """The same messages inside the schema/payload wrapper, with cut-off messages mixed in that are skipped."""
    whole = debezium_messages(spark, sf).select(
        F.concat(F.lit('{"schema":{},"payload":'), F.col("value").cast("string"), F.lit("}")).alias("value")
    )
    broken = whole.select(F.expr("left(value, 40)").alias("value"))
    df = whole.unionByName(broken)
    return _shown(messages.decode_debezium(df, schema=CUSTOMER, include_schema=True, ignore_errors=True))


# Canal writes every value as text; `old` has the changed field only.
_TEXT_ROW = "map('c_custkey', string(c_custkey), 'c_name', c_name, 'c_acctbal', string(c_acctbal))"
_TEXT_OLD = "if(c_mktsegment = 'MACHINERY', map('c_acctbal', string(c_acctbal - 1)), null)"


@query("decode_canal", DECODED_SQL)
def decode_canal(spark, sf):
    df = _messages(
        spark, sf, "'data'", f"array({_TEXT_ROW})", "'old'", f"array({_TEXT_OLD})", "'database'", "'shop'",
        "'table'", "'customer'", "'type'", _kinds("DELETE", "UPDATE", "INSERT"), "'es'", "1700000000000", "'isDdl'", "false",
    )
    other = df.select(F.replace(F.col("value").cast("string"), F.lit('"shop"'), F.lit('"depot"')).cast("binary").alias("value"))
    ddl = df.select(F.replace(F.col("value").cast("string"), F.lit('"isDdl":false'), F.lit('"isDdl":true')).cast("binary").alias("value"))
    return _shown(
        messages.decode_canal(
            df.unionByName(other).unionByName(ddl), schema=CUSTOMER, database_include="sh.*", table_include="customer"
        )
    )


@query("decode_maxwell", DECODED_SQL)
def decode_maxwell(spark, sf):
    df = _messages(
        spark, sf, "'database'", "'shop'", "'table'", "'customer'", "'type'", _kinds("delete", "update", "insert"),
        "'ts'", "1700000000", "'data'", _ROW, "'old'", "if(c_mktsegment = 'MACHINERY', named_struct('c_acctbal', c_acctbal - 1), null)",
    )
    return _shown(messages.decode_maxwell(df, schema=CUSTOMER, database_include="shop"))


@query("decode_ogg", DECODED_SQL.replace("1700000000000", "1589384406000").replace("shop.customer", "SHOP.CUSTOMER"))
def decode_ogg(spark, sf):
    before = f"if(c_mktsegment = 'BUILDING', {_ROW}, if(c_mktsegment = 'MACHINERY', {_OLD}, {_NULL_ROW}))"
    after = f"if(c_mktsegment = 'BUILDING', {_NULL_ROW}, {_ROW})"
    df = _messages(
        spark, sf, "'before'", before, "'after'", after, "'op_type'", _kinds("D", "U", "I"),
        "'op_ts'", "'2020-05-13 15:40:06.000000'", "'table'", "'SHOP.CUSTOMER'",
    )
    return _shown(messages.decode_ogg(df, schema=CUSTOMER, table_include="CUST.*"))


@query(
    "decode_connect_json",
    """SELECT c_custkey, c_name, c_acctbal, CASE c_mktsegment WHEN 'BUILDING' THEN '-D' ELSE '+I' END AS kind FROM customer""",
)
def decode_connect_json(spark, sf):
    """Plain rows and Debezium events in Connect envelopes."""
    payload = f"""if(c_mktsegment = 'BUILDING', to_json(named_struct('before', {_ROW}, 'op', 'd')), to_json({_ROW}))"""
    df = table(spark, sf, "customer").select(
        F.concat(F.lit('{"schema":{"type":"struct"},"payload":'), F.expr(payload), F.lit("}")).alias("value")
    )
    done = messages.decode_connect_json(df, schema=CUSTOMER)
    return done.select("c_custkey", "c_name", "c_acctbal", F.col(KIND).alias("kind"))


@query(
    "passthrough_debezium",
    """SELECT c_custkey, 'changes' AS topic, hex('{"id":' || c_custkey || '}') AS key_bytes,
              hex('{"id": ' || c_custkey || ', "name":"' || c_name || '" }') AS value_bytes FROM customer""",
)
def passthrough_debezium(spark, sf):
    """Byte for byte: blanks inside the JSON stay."""
    df = table(spark, sf, "customer").select(
        F.expr("""concat('{"id":', c_custkey, '}')""").cast("binary").alias("key"),
        F.expr("""concat('{"id": ', c_custkey, ', "name":"', c_name, '" }')""").cast("binary").alias("value"),
        F.lit("changes").alias("topic"),
        F.lit(1).alias("partition"),
    )
    identity = F.get_json_object(F.col("key").cast("string"), "$.id").cast("bigint")
    return messages.passthrough_debezium(df).select(
        identity.alias("c_custkey"), "topic", F.hex("key").alias("key_bytes"), F.hex("value").alias("value_bytes")
    )


def _nation_changes(spark, sf) -> DataFrame:
    """Customers as changes with an integer and a text field."""
    return table(spark, sf, "customer").select("c_custkey", "c_name", F.expr(_kinds("-D", "+U", "+I")).alias(KIND))


_JSON_ROW = """'{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}'"""
_GONE = "c_mktsegment = 'BUILDING'"


@query(
    "encode_debezium",
    f"""SELECT CASE WHEN {_GONE} THEN '{{"before":' || {_JSON_ROW} || ',"after":null,"op":"d"}}'
               ELSE '{{"before":null,"after":' || {_JSON_ROW} || ',"op":"c"}}' END AS value FROM customer""",
)
def encode_debezium(spark, sf):
    return messages.encode_changelog(_nation_changes(spark, sf), fmt="debezium")


@query(
    "encode_canal",
    f"""SELECT '{{"data":[' || {_JSON_ROW} || '],"type":"' || CASE WHEN {_GONE} THEN 'DELETE' ELSE 'INSERT' END || '"}}' AS value FROM customer""",
)
def encode_canal(spark, sf):
    return messages.encode_changelog(_nation_changes(spark, sf), fmt="canal")


@query(
    "encode_maxwell",
    f"""SELECT '{{"data":' || {_JSON_ROW} || ',"type":"' || CASE WHEN {_GONE} THEN 'delete' ELSE 'insert' END || '"}}' AS value FROM customer""",
)
def encode_maxwell(spark, sf):
    return messages.encode_changelog(_nation_changes(spark, sf), fmt="maxwell")


@query(
    "encode_ogg",
    f"""SELECT CASE WHEN {_GONE} THEN '{{"before":' || {_JSON_ROW} || ',"after":null,"op_type":"D"}}'
               ELSE '{{"before":null,"after":' || {_JSON_ROW} || ',"op_type":"I"}}' END AS value FROM customer""",
)
def encode_ogg(spark, sf):
    return messages.encode_changelog(_nation_changes(spark, sf), fmt="ogg")


@query(
    "to_messages",
    """SELECT '{"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '"}' AS key,
              c_custkey || '|' || c_name || '|' || c_mktsegment AS value, 'seg_' || c_mktsegment AS topic FROM customer""",
)
def to_messages(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    done = messages.to_messages(
        df, key_fields=["c_custkey", "c_mktsegment"], fmt="text", field_delimiter="|", topic=F.concat(F.lit("seg_"), "c_mktsegment")
    )
    return done.select("topic", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


@query("decode_json_messages", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def decode_json_messages(spark, sf):
    df = messages.to_messages(table(spark, sf, "orders"), key_fields=["o_orderkey"]).drop("key")
    return messages.decode_json(df, schema={"o_orderkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double"})


@query("decode_text_messages", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def decode_text_messages(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    df = messages.to_messages(rows, fmt="text", field_delimiter=";").drop("key")
    return messages.decode_text(df, delimiter=";", schema={"o_orderkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double"})


def _change(price: str, kind: str, seq: int) -> str:
    return f"named_struct('o_totalprice', {price}, '{KIND}', '{kind}', '{SEQ}', {seq}L)"


def orders_changelog(spark, sf) -> DataFrame:
    """Every order is inserted; those of status P are then updated (a before- and an after-image), those of status F
    deleted."""
    return table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.expr(
            """inline(CASE o_orderstatus WHEN 'P' THEN array({inserted}, {before}, {after})
                      WHEN 'F' THEN array({inserted}, {deleted}) ELSE array({inserted}) END)""".format(
                inserted=_change("o_totalprice", "+I", 0),
                before=_change("o_totalprice", "-U", 1),
                after=_change("o_totalprice + 1", "+U", 1),
                deleted=_change("o_totalprice", "-D", 1),
            )
        ),
    )


FOLDED_SQL = """SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
                FROM orders WHERE o_orderstatus <> 'F'"""


@query("fold_changelog", FOLDED_SQL)
def fold_changelog(spark, sf):
    return changelog.fold_changelog(orders_changelog(spark, sf), keys=["o_orderkey"])


def _move(priority: str, kind: str) -> str:
    return f"named_struct('o_orderpriority', {priority}, '{KIND}', '{kind}')"


@query(
    "fold_retractions",
    """SELECT o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus = 'O'
       UNION ALL SELECT o_orderstatus, 'moved' FROM orders WHERE o_orderstatus = 'P'""",
)
def fold_retractions(spark, sf):
    """A table without a key: rows repeat, and each order's rows come and go."""
    changes = table(spark, sf, "orders").select(
        "o_orderstatus",
        F.expr(
            """inline(CASE o_orderstatus WHEN 'P' THEN array({inserted}, {before}, {after})
                      WHEN 'F' THEN array({inserted}, {deleted}) ELSE array({inserted}) END)""".format(
                inserted=_move("o_orderpriority", "+I"),
                before=_move("o_orderpriority", "-U"),
                after=_move("'moved'", "+U"),
                deleted=_move("o_orderpriority", "-D"),
            )
        ),
    )
    return changelog.fold_retractions(changes)


def lineitem_changes(spark, sf) -> DataFrame:
    """Line items as changes of their order: status and price of the last one count, a return flag R deletes."""
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_linestatus").alias("o_orderstatus"),
        F.col("l_extendedprice").alias("o_totalprice"),
        F.expr("CASE l_returnflag WHEN 'R' THEN '-D' WHEN 'A' THEN '+U' ELSE '-U' END").alias(KIND),
        # Line numbers repeat inside an order, so part and supplier are part of the position.
        ((F.col("l_linenumber").cast("bigint") * 1_000_000_000 + F.col("l_partkey")) * 100_000 + F.col("l_suppkey")).alias(SEQ),
    )


APPLIED_SQL = """
    WITH last AS (
      SELECT l_orderkey, arg_max(l_linestatus, s) AS status, arg_max(l_extendedprice, s) AS price, arg_max(l_returnflag, s) AS flag
      FROM (SELECT *, (l_linenumber::BIGINT * 1000000000 + l_partkey) * 100000 + l_suppkey AS s FROM lineitem WHERE l_returnflag <> 'N')
      GROUP BY l_orderkey)
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM last)
    UNION ALL SELECT l_orderkey, status, price FROM last WHERE flag <> 'R'"""


@query("apply_changelog", APPLIED_SQL)
def apply_changelog(spark, sf):
    target = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return changelog.apply_changelog(target, lineitem_changes(spark, sf), keys=["o_orderkey"])


@query("stream_apply_changelog", APPLIED_SQL)
def stream_apply_changelog_query(spark, sf):
    """The same changes arriving in three parts; the table is compacted on the way, and the last batch is handed in a
    second time."""
    source, checkpoint = scratch_dir(spark, "changes"), scratch_dir(spark, "checkpoint")
    changes = lineitem_changes(spark, sf)
    target = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    keyed = KeyedTable(spark, scratch_dir(spark, "keyed"), keys=["o_orderkey"], schema=target.schema)
    line = F.floor(F.col(SEQ) / 100_000_000_000_000)
    for part, snapshot in ((line <= 2, target), (line.between(3, 4), None), (line >= 5, None)):
        changes.where(part).write.mode("append").parquet(source)
        stream = scan_stream(spark, source, schema=changes.schema)
        run_to_end(stream_apply_changelog(stream, keyed, checkpoint, snapshot=snapshot, compact_every=2))
    keyed.apply(changes, 2)
    return keyed.read()


@query("stream_late_changes", APPLIED_SQL)
def stream_late_changes(spark, sf):
    """The newest changes arrive first and the oldest last, each restart passes the snapshot again, a finished batch is
    handed in twice and the table is compacted in between: the order is that of the sequence numbers all the same."""
    source, checkpoint = scratch_dir(spark, "changes"), scratch_dir(spark, "checkpoint")
    changes = lineitem_changes(spark, sf)
    target = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    keyed = KeyedTable(spark, scratch_dir(spark, "keyed"), keys=["o_orderkey"], schema=target.schema)
    line = F.floor(F.col(SEQ) / 100_000_000_000_000)
    for part in (line >= 5, line.between(3, 4), line <= 2):
        changes.where(part).write.mode("append").parquet(source)
        stream = scan_stream(spark, source, schema=changes.schema)
        run_to_end(stream_apply_changelog(stream, keyed, checkpoint, snapshot=target, compact_every=2))
    keyed.apply(changes, 1)
    return keyed.read()


@query(
    "stream_fold_changelog",
    APPLIED_SQL[: APPLIED_SQL.index("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")]
    + "SELECT l_orderkey AS o_orderkey, status AS o_orderstatus, price AS o_totalprice FROM last WHERE flag <> 'R'",
)
def stream_fold_changelog(spark, sf):
    """Changes folded by keyed state inside the stream: the newest arrive first and the oldest last, with a restart after
    each part, so late changes and late deletes meet what is remembered."""
    source, out, checkpoint = (scratch_dir(spark, x) for x in ("changes", "folded", "checkpoint"))
    changes, line = lineitem_changes(spark, sf), F.floor(F.col(SEQ) / 100_000_000_000_000)
    for part in (line >= 5, line.between(3, 4), line <= 2):
        changes.where(part).write.mode("append").parquet(source)
        run_to_end(stream_fold(scan_stream(spark, source, schema=changes.schema), out, checkpoint, keys=["o_orderkey"]))
    return changelog.fold_changelog(spark.read.schema(changes.schema).parquet(out), keys=["o_orderkey"])


def _customer_log(spark, sf) -> tuple[DataFrame, DataFrame]:
    """A snapshot of the customers and changes of two segments: one is updated, the other deleted."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    changes = customers.where("c_mktsegment IN ('BUILDING', 'MACHINERY')").select(
        "c_custkey",
        "c_name",
        F.expr("if(c_mktsegment = 'MACHINERY', c_acctbal + 1, c_acctbal)").alias("c_acctbal"),
        F.expr("if(c_mktsegment = 'MACHINERY', '+U', '-D')").alias(KIND),
        (F.col("c_custkey") + 1).cast("bigint").alias(SEQ),
        (F.col("c_custkey") * 1000).cast("bigint").alias(EVENT_MS),
    )
    return customers.drop("c_mktsegment"), changes


@query(
    "stream_snapshot_handover",
    """SELECT c_custkey, c_name, CASE c_mktsegment WHEN 'MACHINERY' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal
       FROM customer WHERE c_mktsegment <> 'BUILDING'""",
)
def stream_snapshot_handover(spark, sf):
    """One stream for snapshot and changes into a keyed table. It is killed when the first batch of changes comes, started
    again, and once more after further changes have been written."""
    snapshot, changes = _customer_log(spark, sf)
    snapshot_path, changes_path, checkpoint = (scratch_dir(spark, x) for x in ("snapshot", "changes", "checkpoint"))
    keyed = KeyedTable(spark, scratch_dir(spark, "keyed"), keys=["c_custkey"], schema=snapshot.schema)
    snapshot.write.parquet(snapshot_path)
    middle = changes.agg(F.percentile_approx(SEQ, 0.5)).first()[0]
    changes.where(F.col(SEQ) <= middle).write.parquet(changes_path)
    killed = []

    def take(batch: DataFrame, batch_id: int) -> None:
        if not killed and not batch.where(F.col(SEQ) > 0).isEmpty():
            killed.append(batch_id)
            raise RuntimeError("killed between the snapshot and the changes")
        keyed.apply(batch, batch_id)

    def run() -> None:
        stream = scan_snapshot_then_changes(spark, snapshot_path, changes_path, schema=snapshot.schema)
        drain(stream.writeStream.foreachBatch(take), checkpoint)

    try:
        run()
    except Exception:
        if not killed:
            raise
    run()
    changes.where(F.col(SEQ) > middle).write.mode("append").parquet(changes_path)
    run()
    return keyed.read()


@query(
    "stream_rows_limited",
    """SELECT 'snapshot' AS phase, count(*) AS n_rows, true AS within_limit, true AS in_order FROM customer
       UNION ALL SELECT 'changes', count(*) FILTER (c_mktsegment IN ('BUILDING', 'MACHINERY')), true, true FROM customer""",
)
def stream_rows_limited(spark, sf):
    """A rate in rows: no batch of either phase holds more than a seventh of the rows, and no batch of changes begins before
    the one before it ends."""
    snapshot, changes = _customer_log(spark, sf)
    paths = [scratch_dir(spark, x) for x in ("snapshot", "changes", "batches")]
    for df, path in ((snapshot, paths[0]), (changes, paths[1])):
        df.write.parquet(path)
    limit = snapshot.count() // 7 + 1
    stream = scan_snapshot_then_changes(spark, *paths[:2], schema=snapshot.schema, rows_per_batch=limit)

    def note(batch: DataFrame, batch_id: int) -> None:
        sizes = batch.agg(F.count(F.lit(1)).alias("n"), F.min(SEQ).alias("low"), F.max(SEQ).alias("high"))
        sizes.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{paths[2]}/{batch_id}")

    drain(stream.writeStream.foreachBatch(note), scratch_dir(spark, "checkpoint"))
    noted = spark.read.schema("n bigint, low bigint, high bigint, batch int").option("recursiveFileLookup", "true").parquet(paths[2])
    before = F.lag("high").over(Window.partitionBy(F.col("high") > 0).orderBy("batch"))
    marked = noted.where("n > 0").withColumn("after", F.coalesce((F.col("high") == 0) | (F.col("low") > before), F.lit(True)))
    return marked.groupBy(F.when(F.col("high") == 0, "snapshot").otherwise("changes").alias("phase")).agg(
        F.sum("n").alias("n_rows"), (F.max("n") <= limit).alias("within_limit"), F.every("after").alias("in_order")
    )


@query(
    "keyed_table_levels",
    """WITH n AS (SELECT count(*) AS n FROM orders)
       SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 10 < 6 THEN o_totalprice + (o_orderkey % 10) ELSE o_totalprice END AS o_totalprice
       FROM orders WHERE o_orderkey % 10 <> 9""",
)
def keyed_table_levels(spark, sf):
    """Batches of changes that merge through several levels of small pieces: every batch changes the orders of one digit
    and those of all later ones, the last deletes some, and a replay of an earlier batch changes nothing."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    keyed = KeyedTable(
        spark, scratch_dir(spark, "keyed"), keys=["o_orderkey"], schema=orders.schema, fan=2, piece_bytes=64 << 10, retention_seconds=0
    )
    keyed.load(orders)
    digit = F.col("o_orderkey") % 10
    for batch in range(6):
        part = orders.where(digit.between(batch, 5)).withColumns(
            {"o_totalprice": F.col("o_totalprice") + batch, KIND: F.lit("+U"), SEQ: F.lit(batch + 1).cast("bigint")}
        )
        keyed.apply(part, batch)
    gone = orders.where(digit == 9).withColumns({KIND: F.lit("-D"), SEQ: F.lit(9).cast("bigint")})
    keyed.apply(gone, 6)
    keyed.apply(gone.withColumn(KIND, F.lit("+U")), 2)
    return keyed.read()


@query(
    "evolve_schema",
    """SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) AS c_nationkey, 'yy' AS add_column1, 1.5::DOUBLE AS add_column3,
              c_name, c_mktsegment FROM customer""",
)
def evolve_schema(spark, sf):
    return evolve.evolve_schema(
        table(spark, sf, "customer"),
        [
            evolve.AddColumn("add_column1", "string", default="yy"),
            evolve.AddColumn("add_column2", "int"),
            evolve.AddColumn("add_column3", "double", default=1.5, after="c_name"),
            evolve.ModifyColumn("c_nationkey", "bigint"),
            evolve.RenameColumn("c_custkey", "id"),
            evolve.DropColumn("add_column2"),
            evolve.DropColumn("c_acctbal"),
        ],
    )


@query(
    "evolve_tables",
    """SELECT 'shop.nations' AS table_path, count(*) AS n_rows, 2 AS n_columns FROM nation
       UNION ALL SELECT 'shop.region', count(*), 3 FROM region""",
)
def evolve_tables(spark, sf):
    tables = TableSet.of({"shop.nation": table(spark, sf, "nation"), "shop.region": table(spark, sf, "region")})
    done = evolve.evolve_tables(
        tables,
        [
            ("shop.nation", evolve.DropColumn("n_regionkey")),
            evolve.RenameTable("shop.nation", "shop.nations"),
            ("shop.region", evolve.AddColumn("r_comment", "string", default="-")),
        ],
    )
    out = None
    for path, df in done.items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(str(path)).alias("table_path"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "stream_schema_evolution",
    """SELECT event_id, event_type AS kind, user_id, CASE WHEN event_type IN ('click', 'error') THEN 'none' ELSE 'v-' || event_id END AS note
       FROM events""",
)
def stream_schema_evolution(spark, sf):
    """Events in three files: a column is added between the first and the second, one is renamed inside the last."""
    events = table(spark, sf, "events")
    schema = T.StructType().add("event_id", "long").add("event_type", "string").add("user_id", "integer")
    source = scratch_dir(spark, "evolving")
    seq = F.col("event_id") + 1
    top = 1 << 40
    old_row = "to_json(named_struct('event_id', event_id, 'event_type', event_type, 'user_id', user_id))"
    noted = "to_json(named_struct('event_id', event_id, 'event_type', event_type, 'user_id', user_id, 'note', concat('v-', event_id)))"
    last_row = "to_json(named_struct('event_id', event_id, 'kind', event_type, 'user_id', user_id, 'note', concat('v-', event_id)))"

    def ddl(event, at: int) -> DataFrame:
        return spark.createDataFrame([(event_message(event), at)], f"value string, `{SEQ}` bigint")

    def rows(kinds: list[str], body: str, offset: int) -> DataFrame:
        return events.where(F.col("event_type").isin(kinds)).select(F.expr(body).alias("value"), (seq + offset).alias(SEQ))

    batches = [
        rows(["click", "error"], old_row, 0),
        ddl(evolve.AddColumn("note", "string", default="none"), top).unionByName(rows(["view"], noted, top)),
        rows(["signup"], noted, 2 * top)
        .unionByName(ddl(evolve.RenameColumn("event_type", "kind"), 3 * top))
        .unionByName(ddl(evolve.ModifyColumn("user_id", "bigint"), 3 * top + 1))
        .unionByName(rows(["purchase"], last_row, 3 * top + 1)),
    ]
    sink = EvolvingTable(spark, scratch_dir(spark, "evolved"), schema)
    checkpoint = scratch_dir(spark, "checkpoint")
    for batch in batches:
        # Each run picks up the new files and continues from the checkpoint.
        batch.write.mode("append").parquet(source)
        stream = scan_stream(spark, source, schema=T.StructType().add("value", "string").add(SEQ, "long"))
        run_to_end(stream_for_each(stream, sink.apply, checkpoint))
    return sink.read().drop(SEQ)


@query("stream_file_exactly_once", "SELECT * FROM events")
def stream_file_exactly_once(spark, sf):
    schema = table(spark, sf, "events").schema
    out = scratch_dir(spark, "exactly-once")
    stream = scan_stream(spark, f"{sf}/events.parquet*", schema=schema)
    run_to_end(stream_to_files(stream, out, scratch_dir(spark, "checkpoint"), partition_by=["event_type"]))
    return spark.read.schema(schema).parquet(out).select(*schema.names)


@query("stream_restart_no_dup", "SELECT * FROM customer")
def stream_restart_no_dup(spark, sf):
    """Half of the files, a restart with nothing new, the other half, and one more restart."""
    customer = table(spark, sf, "customer")
    source, out, checkpoint = (scratch_dir(spark, label) for label in ("restart-in", "restart-out", "checkpoint"))
    first = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    for part in (customer.where(first), None, customer.where(~first), None):
        if part is not None:
            part.write.mode("append").parquet(source)
        stream = scan_stream(spark, source, schema=customer.schema)
        run_to_end(stream_to_files(stream, out, checkpoint))
    return spark.read.schema(customer.schema).parquet(out)


_ORDER_BYTES = "32 + strlen(o_orderstatus) + strlen(o_orderpriority)"
_CUSTOMER_BYTES = "20 + strlen(c_name) + strlen(c_mktsegment)"


@query(
    "job_counts",
    f"""SELECT 'shop.orders' AS table_path, count(*) AS source_received_count, CAST(sum({_ORDER_BYTES}) AS BIGINT) AS source_received_bytes,
               count(*) FILTER (o_totalprice > 200000) AS sink_write_count,
               CAST(sum({_ORDER_BYTES}) FILTER (o_totalprice > 200000) AS BIGINT) AS sink_write_bytes,
               count(*) FILTER (o_totalprice > 200000) AS sink_committed_count FROM orders
        UNION ALL SELECT 'shop.customer', count(*), CAST(sum({_CUSTOMER_BYTES}) AS BIGINT), count(*),
               CAST(sum({_CUSTOMER_BYTES}) AS BIGINT), count(*) FROM customer""",
)
def job_counts_query(spark, sf):
    tables = TableSet.of({"shop.orders": table(spark, sf, "orders"), "shop.customer": table(spark, sf, "customer")})
    root = scratch_dir(spark, "counted")

    def transform(path, df):
        return df.where("o_totalprice > 200000") if path.table == "orders" else df

    counts = job_counts(tables, transform, lambda path, df: write_files(df, f"{root}/{path.table}"))
    return counts.select(
        F.col("table").alias("table_path"),
        "source_received_count",
        "source_received_bytes",
        "sink_write_count",
        "sink_write_bytes",
        "sink_committed_count",
    )


@query(
    "stream_route_tables",
    """SELECT 'customer' AS table_name, count(*) AS n_rows, CAST(sum(c_custkey) AS BIGINT) AS key_sum FROM customer WHERE c_mktsegment <> 'BUILDING'
       UNION ALL SELECT 'supplier', count(*), CAST(sum(s_suppkey) AS BIGINT) FROM supplier""",
)
def stream_route_tables(spark, sf):
    """Change messages of two tables in one stream, each folded into its own table; a third table's are left alone."""
    supplier = {"s_suppkey": "bigint", "s_name": "string"}
    body = """to_json(named_struct('after', named_struct('s_suppkey', s_suppkey, 's_name', s_name), 'op', 'c',
                                   'source', named_struct('db', 'shop', 'table', '{}')))"""
    suppliers = table(spark, sf, "supplier")
    messages_ = debezium_messages(spark, sf)
    for name in ("supplier", "unknown"):
        messages_ = messages_.unionByName(suppliers.select(F.expr(body.format(name)).cast("binary").alias("value")))
    source = scratch_dir(spark, "messages")
    messages_.withColumn(SEQ, F.monotonically_increasing_id()).write.parquet(source)

    def keyed(name: str, schema: dict) -> tuple:
        key = next(iter(schema))
        target = KeyedTable(spark, scratch_dir(spark, name), keys=[key], schema=schema_from_fields(schema))
        return lambda rows: messages.decode_debezium(rows, schema=schema), target

    routes = {"customer": keyed("customer", CUSTOMER), "supplier": keyed("supplier", supplier)}
    stream = scan_stream(spark, source, schema=T.StructType().add("value", "binary").add(SEQ, "long"))
    table_of = F.get_json_object(F.col("value").cast("string"), "$.source.table")
    run_to_end(stream_route_changelog(stream, routes, scratch_dir(spark, "checkpoint"), table_of=table_of))
    out = None
    for name, (_, target) in routes.items():
        one = target.read().agg(F.count(F.lit(1)).alias("n_rows"), F.sum(target.keys[0]).alias("key_sum"))
        one = one.select(F.lit(name).alias("table_name"), "n_rows", "key_sum")
        out = one if out is None else out.unionByName(one)
    return out
