"""Scalar and vector functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions import ivf, murmur, scalar, vectors
from millrace.operators.sql import sql
from millrace.session import scratch_dir, written
from workloads.registry import query, table


@query(
    "fn_concat_arith",
    "SELECT o_orderkey, o_orderstatus || '_' || o_orderpriority AS tag, o_custkey + 1 AS next, o_totalprice > 100000 AS big, 'x' AS lit FROM orders",
)
def fn_concat_arith(spark: SparkSession, sf: str) -> DataFrame:
    return sql(
        table(spark, sf, "orders"),
        "select o_orderkey, concat(o_orderstatus, '_', o_orderpriority) as tag, o_custkey + 1 as next, o_totalprice > 100000 as big, 'x' as lit from dual",
    )


@query(
    "fn_regexp_pi",
    r"SELECT page_id, regexp_replace(url, '[0-9]+', 'N', 'g') AS pattern, pi() AS pi FROM pages",
)
def fn_regexp_pi(spark, sf):
    return sql(table(spark, sf, "pages"), "select page_id, regexp_replace(url, '[0-9]+', 'N') as pattern, pi() as pi from dual")


@query(
    "fn_cast",
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, CAST(trunc(o_totalprice) AS BIGINT) AS price,
              CAST(o_orderkey AS VARCHAR) AS key_text, CAST(NULL AS VARCHAR) AS nothing FROM orders""",
)
def fn_cast(spark, sf):
    return sql(
        table(spark, sf, "orders"),
        """select o_orderkey, cast(cast(o_orderdate as date) as string) as day, cast(o_totalprice as bigint) as price,
                  cast(o_orderkey as string) as key_text, cast(null as string) as nothing from dual""",
    )


@query(
    "fn_from_unixtime_tz",
    """SELECT event_id, strftime(date_trunc('second', ts) + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS local FROM events""",
)
def fn_from_unixtime_tz(spark, sf):
    seconds = F.floor(scalar.epoch_millis(F.col("ts"), zoneless=True) / 1000)
    return table(spark, sf, "events").select(
        "event_id", scalar.from_unixtime_tz(seconds, "yyyy-MM-dd HH:mm:ss", "Asia/Shanghai").alias("local")
    )


@query(
    "fn_datediff_month",
    """SELECT l_orderkey, l_linenumber, l_partkey, date_sub('month', DATE '1992-01-15', l_shipdate::DATE) AS months,
              date_diff('day', DATE '1992-01-15', l_shipdate::DATE) AS days FROM lineitem""",
)
def fn_datediff_month(spark, sf):
    start = F.lit("1992-01-15").cast("date")
    ship = F.col("l_shipdate").cast("date")
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        scalar.datediff_unit(start, ship, "MONTH").alias("months"),
        scalar.datediff_unit(start, ship).alias("days"),
    )


@query("fn_week", "SELECT o_orderkey, CAST(week(o_orderdate) AS INTEGER) AS week FROM orders")
def fn_week(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", scalar.week(F.col("o_orderdate")).alias("week"))


def _murmur_sql() -> str:
    """The published algorithm over 128-bit integers: blocks of 16 bytes as 32 hexadecimal digits, folded in order."""
    m = "18446744073709551616::UHUGEINT"
    mul = lambda a, c: f"((({a})::UHUGEINT * {c}::UHUGEINT) % {m})::UBIGINT"
    add = lambda a, b: f"((({a})::UHUGEINT + ({b})::UHUGEINT) % {m})::UBIGINT"
    rotl = lambda x, r: f"(((({x})::UHUGEINT * {2**r}::UHUGEINT) % {m}) + ({x})::UHUGEINT // {2 ** (64 - r)}::UHUGEINT)::UBIGINT"
    c1, c2 = murmur._C1, murmur._C2
    little = lambda x, o: "('0x' || " + " || ".join(f"substr({x}, {o + 2 * i}, 2)" for i in range(7, -1, -1)) + ")::UBIGINT"
    k1 = lambda x: mul(rotl(mul(little(x, 1), c1), 31), c2)
    k2 = lambda x: mul(rotl(mul(little(x, 17), c2), 33), c1)
    h1 = add(mul(add(rotl("xor(h.a, k.a)", 27), "h.b"), 5), murmur._ADD1)
    h2 = add(mul(add(rotl("xor(h.b, k.b)", 31), h1), 5), murmur._ADD2)

    def mixed(x: str) -> str:
        return f"(SELECT xor(z, z >> 33) FROM (SELECT {mul('xor(y, y >> 33)', murmur._MIX2)} AS z FROM (SELECT {mul(f'xor({x}, {x} >> 33)', murmur._MIX1)} AS y)))"

    zero = "{'a': 0::UBIGINT, 'b': 0::UBIGINT}"
    return f"""
    WITH texts AS (
      SELECT doc_id, 'text' AS which, text AS s FROM documents UNION ALL SELECT doc_id, 'source', source FROM documents),
    cut AS (
      SELECT doc_id, which, strlen(s)::UBIGINT AS n, regexp_extract_all(hex(s), '.{{32}}') AS blocks,
             rpad(substr(hex(s), (strlen(s) // 16 * 32 + 1)::BIGINT), 32, '0') AS tail
      FROM texts),
    folded AS (
      SELECT doc_id, which, n, tail,
             list_reduce(list_prepend({zero}, list_transform(blocks, lambda x: {{'a': {k1("x")}, 'b': {k2("x")}}})),
                         lambda h, k: {{'a': {h1}, 'b': {h2}}}) AS h
      FROM cut),
    ends AS (SELECT doc_id, which, xor(xor(h.a, {k1("tail")}), n) AS a, xor(xor(h.b, {k2("tail")}), n) AS b FROM folded),
    sums AS (SELECT doc_id, which, a1, {add("a1", "b")} AS b1 FROM (SELECT *, {add("a", "b")} AS a1 FROM ends)),
    hashes AS (SELECT doc_id, which, {add(mixed("a1"), mixed("b1"))}::HUGEINT AS u FROM sums),
    signed AS (
      SELECT doc_id, which, (CASE WHEN u >= 9223372036854775808 THEN u - 18446744073709551616 ELSE u END)::BIGINT AS v FROM hashes)
    SELECT doc_id, max(v) FILTER (which = 'text') AS text_hash, max(v) FILTER (which = 'source') AS source_hash
    FROM signed GROUP BY doc_id
    """


@query("fn_murmur64", _murmur_sql())
def fn_murmur64(spark, sf):
    return sql(
        table(spark, sf, "documents"),
        "select doc_id, MURMUR64(text) as text_hash, MURMUR64(source) as source_hash from dual",
        functions={"MURMUR64": murmur.MURMUR64},
    )


@query(
    "fn_array",
    "SELECT c_custkey, c_nationkey AS first, 7 AS second, 2 AS n_inner FROM customer",
)
def fn_array(spark, sf):
    return sql(
        table(spark, sf, "customer"),
        """select c_custkey, a[0][0] as first, a[1][0] as second, size(a) as n_inner
           from (select c_custkey, array(array(c_nationkey, 1), array(7)) as a from dual)""",
    )


@query(
    "fn_map",
    "SELECT c_custkey, c_mktsegment AS seg, CAST(NULL AS VARCHAR) AS none, c_name AS deep FROM customer",
)
def fn_map(spark, sf):
    return sql(
        table(spark, sf, "customer"),
        """select c_custkey, m['seg'] as seg, m['absent'] as none, n['a']['b'] as deep
           from (select c_custkey, map('seg', c_mktsegment) as m, map('a', map('b', c_name)) as n from dual)""",
    )


@query(
    "fn_parse_date_auto",
    """SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'P' THEN NULL ELSE o_orderdate::DATE END AS VARCHAR) AS parsed FROM orders""",
)
def fn_parse_date_auto(spark, sf):
    """Dates written in a form that depends on the order's priority; orders of status P have none that exists."""
    text = F.expr(
        """CASE WHEN o_orderstatus = 'P' THEN '2023-02-30'
                WHEN o_orderpriority LIKE '1%' THEN date_format(o_orderdate, 'yyyy/MM/dd')
                WHEN o_orderpriority LIKE '2%' THEN date_format(o_orderdate, 'yyyyMMdd')
                WHEN o_orderpriority LIKE '3%' THEN date_format(o_orderdate, 'yyyy年MM月dd日')
                WHEN o_orderpriority LIKE '4%' THEN date_format(o_orderdate, 'yyyy.MM.dd')
                WHEN o_orderstatus = 'F' THEN date_format(o_orderdate, 'yyyy/M/d')
                ELSE date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss") END"""
    )
    return table(spark, sf, "orders").select("o_orderkey", scalar.parse_date_auto(text).cast("string").alias("parsed"))


@query(
    "fn_parse_time_auto",
    """SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN strftime(ts, '%H:%M:%S') ELSE strftime(ts, '%H:%M:%S') || '.250' END AS parsed
       FROM events""",
)
def fn_parse_time_auto(spark, sf):
    text = F.expr(
        """CASE event_type WHEN 'error' THEN date_format(ts, '99:mm:ss') WHEN 'view' THEN date_format(ts, 'HH:mm:ss')
           ELSE concat(date_format(ts, 'HH:mm:ss'), '.250') END"""
    )
    return table(spark, sf, "events").select("event_id", scalar.parse_time_auto(text).alias("parsed"))


def whole_numbers(vector) -> Column:
    """A vector in thousandths, so that sums are exact in any order and both engines agree to the last digit."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 1000).cast("double"))


def centers(spark, sf) -> DataFrame:
    """One vector per label: the element-wise mean, rounded down."""
    vectors_ = table(spark, sf, "embeddings").select("label", F.posexplode(whole_numbers("embedding")).alias("pos", "x"))
    means = vectors_.groupBy("label", "pos").agg(F.floor(F.sum("x") / F.count("x")).cast("double").alias("m"))
    # At most (vector length) means per label are gathered.
    gathered = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("pos", "m"))).alias("pairs"))
    return gathered.select("label", F.transform("pairs", lambda p: p["m"]).alias("center"))


_WHOLE = "list_transform(embedding, lambda x: floor(x::DOUBLE * 1000))"
CENTERS_SQL = f"""
    means AS (SELECT label, pos, floor(sum(x) / count(x)) AS m
              FROM (SELECT label, unnest({_WHOLE}) AS x, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings) GROUP BY 1, 2),
    centers AS (SELECT label, list(m ORDER BY pos) AS center FROM means GROUP BY label),
    pairs AS (SELECT vec_id, {_WHOLE} AS a, center AS b FROM embeddings JOIN centers USING (label))"""


def with_center(spark, sf) -> DataFrame:
    """Each vector beside its label's center."""
    joined = table(spark, sf, "embeddings").join(written(centers(spark, sf), "centers"), "label")
    return joined.select("vec_id", whole_numbers("embedding").alias("a"), F.col("center").alias("b"))


def _distance_query(name: str, column, sql_pair: str):
    @query(name, f"WITH {CENTERS_SQL} SELECT vec_id, {sql_pair} AS distance FROM pairs")
    def run(spark, sf):
        return with_center(spark, sf).select("vec_id", column(F.col("a"), F.col("b")).alias("distance"))

    return run


_DOT = "list_sum(list_transform(list_zip(a, b), lambda p: p[1] * p[2]))"
vector_l2 = _distance_query(
    "vector_l2", vectors.l2_distance, "sqrt(list_sum(list_transform(list_zip(a, b), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))"
)
vector_ip = _distance_query("vector_ip", vectors.inner_product, _DOT)
vector_cosine = _distance_query(
    "vector_cosine",
    vectors.cosine_distance,
    f"1 - {_DOT} / (sqrt(list_sum(list_transform(a, lambda x: x * x))) * sqrt(list_sum(list_transform(b, lambda x: x * x))))",
)


def _bit_pairs(spark, sf) -> DataFrame:
    """Each vector's sign bits and those of its label's center."""
    signs = {name: F.transform(name, lambda x: x > 0) for name in ("a", "b")}
    return with_center(spark, sf).select("vec_id", *[vectors.pack_bits(f).alias(name) for name, f in signs.items()])


_BITS_SQL = f"""WITH {CENTERS_SQL},
    bits AS (SELECT vec_id, list_zip(list_transform(a, lambda x: x > 0), list_transform(b, lambda x: x > 0)) AS p FROM pairs)"""


@query("vector_hamming", _BITS_SQL + " SELECT vec_id, CAST(len(list_filter(p, lambda b: b[1] <> b[2])) AS INTEGER) AS distance FROM bits")
def vector_hamming(spark, sf):
    return _bit_pairs(spark, sf).select("vec_id", vectors.hamming_distance(F.col("a"), F.col("b")).alias("distance"))


@query(
    "vector_jaccard",
    _BITS_SQL
    + " SELECT vec_id, 1 - len(list_filter(p, lambda b: b[1] AND b[2]))::DOUBLE / len(list_filter(p, lambda b: b[1] OR b[2])) AS distance FROM bits",
)
def vector_jaccard(spark, sf):
    return _bit_pairs(spark, sf).select("vec_id", vectors.jaccard_distance(F.col("a"), F.col("b")).alias("distance"))


@query(
    "sparse_to_dense",
    """SELECT vec_id, CAST(5 + label AS INTEGER) AS n, embedding[1] AS first, embedding[2] AS last, CAST(2 AS BIGINT) AS n_set FROM embeddings""",
)
def sparse_to_dense(spark, sf):
    """Two elements of each vector become a sparse vector; the label says how far apart they are."""
    df = table(spark, sf, "embeddings").select(
        "vec_id", F.expr("map(0, embedding[0], label + 4, embedding[1])").alias("sparse")
    )
    dense = df.withColumn("dense", vectors.sparse_to_dense(F.col("sparse")))
    return dense.select(
        "vec_id",
        F.size("dense").alias("n"),
        F.get("dense", F.lit(0)).alias("first"),
        F.element_at("dense", -1).alias("last"),
        F.size(F.filter("dense", lambda x: x != 0)).cast("bigint").alias("n_set"),
    )


@query("vector_roundtrip", "SELECT vec_id, true AS same, CAST(4 * len(embedding) AS INTEGER) AS n_bytes FROM embeddings")
def vector_roundtrip(spark, sf):
    df = table(spark, sf, "embeddings").withColumn("packed", vectors.pack_vector(F.col("embedding")))
    unpacked = vectors.unpack_vector(F.col("packed"))
    return df.select("vec_id", (unpacked == F.col("embedding")).alias("same"), F.octet_length("packed").alias("n_bytes"))


@query(
    "vector_topk",
    f"""WITH {CENTERS_SQL},
        scored AS (SELECT c.label::BIGINT AS query_id, vec_id,
                          sqrt(list_sum(list_transform(list_zip(a, center), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS distance
                   FROM centers c, pairs)
        SELECT query_id, vec_id, distance, CAST(rank AS INTEGER) AS rank FROM
          (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM scored) WHERE rank <= 5""",
)
def vector_topk(spark, sf):
    """The five vectors nearest to each label's center."""
    queries = centers(spark, sf).select(F.col("label").cast("bigint").alias("query_id"), F.col("center").alias("vector"))
    corpus = table(spark, sf, "embeddings").select("vec_id", whole_numbers("embedding").alias("vector"))
    return vectors.vector_topk(queries, corpus, metric="L2", k=5)


_FAR = "list_transform(embedding, lambda x: floor(x::DOUBLE * 1000) / 2 + 100000000)"


@query(
    "vector_topk_large",
    f"""WITH far AS (SELECT vec_id, {_FAR} AS v FROM embeddings),
        scored AS (SELECT q.vec_id AS query_id, c.vec_id,
                          sqrt(list_sum(list_transform(list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS distance
                   FROM far q, far c WHERE q.vec_id % 50 = 0)
        SELECT query_id, vec_id, distance, CAST(rank AS INTEGER) AS rank FROM
          (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM scored) WHERE rank <= 5""",
)
def vector_topk_large(spark, sf):
    """Vectors far from the origin and close to each other: squared norms alone would tell them apart by rounding."""
    moved = F.transform(whole_numbers("embedding"), lambda x: x / 2 + 100_000_000)
    far = table(spark, sf, "embeddings").select("vec_id", moved.alias("vector"))
    queries = far.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "vector")
    return vectors.vector_topk(queries, far, metric="L2", k=5)


def _embeddings(spark, sf) -> tuple[DataFrame, DataFrame]:
    corpus = table(spark, sf, "embeddings").select("vec_id", whole_numbers("embedding").alias("vector"))
    return corpus.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "vector"), corpus


@query(
    "vector_index_recall",
    """SELECT count(*) AS n_listed, count(*) FILTER (vec_id % 50 = 0) AS n_queries, true AS recall_ok, true AS distances_ok FROM embeddings""",
)
def vector_index_recall(spark, sf):
    """An inverted-list index over all vectors, searched for every fiftieth one: recall at ten against the exact search.
    The given vectors are nearly random, so most lists must be visited."""
    queries, corpus = _embeddings(spark, sf)
    index = ivf.build_index(corpus, scratch_dir(spark, "ivf"), lists=16)
    found = written(ivf.search(spark, index, queries, k=10, probes=13), "ivf-found").withColumnRenamed("distance", "found")
    exact = vectors.vector_topk(queries, corpus, metric="L2", k=10).drop("rank")
    met = exact.join(found.drop("rank"), ["query_id", "vec_id"], "left").agg(
        F.countDistinct("query_id").alias("n_queries"),
        (F.count("found") >= 0.9 * F.count(F.lit(1))).alias("recall_ok"),
        F.coalesce(F.every(F.col("found") == F.col("distance")), F.lit(False)).alias("distances_ok"),
    )
    return met.withColumn("n_listed", F.lit(index.lists(spark).count()).cast("long"))


@query(
    "vector_index_all_lists",
    f"""WITH v AS (SELECT vec_id, {_WHOLE} AS v FROM embeddings),
        scored AS (SELECT q.vec_id AS query_id, c.vec_id,
                          sqrt(list_sum(list_transform(list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS distance
                   FROM v q, v c WHERE q.vec_id % 50 = 0)
        SELECT query_id, vec_id, distance, CAST(rank AS INTEGER) AS rank FROM
          (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM scored) WHERE rank <= 5""",
)
def vector_index_all_lists(spark, sf):
    """A stored index, opened again and probed in all its lists: the exact result."""
    queries, corpus = _embeddings(spark, sf)
    path = scratch_dir(spark, "ivf")
    ivf.build_index(corpus, path, lists=16, rows_per_file=100)
    return ivf.search(spark, ivf.IvfIndex.open(spark, path), queries, k=5, probes=16)
