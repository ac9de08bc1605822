import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import murmur, scalar, vectors

# First 64 bits of the digest of known texts.
KNOWN = {
    "hello world": 5998619086395760910,
    "": 0,
    "test123": -3798313490088110899,
    None: None,
}


def test_murmur_known(spark):
    df = spark.createDataFrame([(t,) for t in KNOWN], "t string")
    assert {r["t"]: r["h"] for r in df.select("t", murmur.murmur64(F.col("t")).alias("h")).collect()} == KNOWN


def plain_murmur(data: bytes) -> int:
    """One value at a time, straight from the published description."""
    mask = (1 << 64) - 1
    c1, c2 = 0x87C37B91114253D5, 0x4CF5AD432745937F

    def rot(x, r):
        return ((x << r) | (x >> (64 - r))) & mask

    def mix(x):
        x = ((x ^ (x >> 33)) * 0xFF51AFD7ED558CCD) & mask
        x = ((x ^ (x >> 33)) * 0xC4CEB9FE1A85EC53) & mask
        return x ^ (x >> 33)

    def k1(k):
        return (rot((k * c1) & mask, 31) * c2) & mask

    def k2(k):
        return (rot((k * c2) & mask, 33) * c1) & mask

    h1 = h2 = 0
    whole = len(data) // 16 * 16
    for at in range(0, whole, 16):
        a, b = struct.unpack_from("<QQ", data, at)
        h1 = ((rot(h1 ^ k1(a), 27) + h2) * 5 + 0x52DCE729) & mask
        h2 = ((rot(h2 ^ k2(b), 31) + h1) * 5 + 0x38495AB5) & mask
    a, b = struct.unpack("<QQ", data[whole:].ljust(16, b"\0"))
    h2 ^= k2(b)
    h1 ^= k1(a)
    h1, h2 = h1 ^ len(data), h2 ^ len(data)
    h1 = (h1 + h2) & mask
    h2 = (h2 + h1) & mask
    h1, h2 = mix(h1), mix(h2)
    return struct.unpack("<q", struct.pack("<Q", (h1 + h2) & mask))[0]


def test_murmur_against_plain():
    rng = random.Random(3)
    texts = [bytes(rng.randrange(256) for _ in range(n)) for n in [*range(40), 64, 100, 1000, 16, 16, 0]]
    rng.shuffle(texts)
    data = np.frombuffer(b"".join(texts), np.uint8)
    lengths = np.array([len(t) for t in texts])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    assert murmur.murmur64_bytes(data, starts, lengths).tolist() == [plain_murmur(t) for t in texts]


def test_murmur_of_utf8_and_slices(spark):
    texts = ["é", "漢字" * 20, None, "plain", ""] * 7
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["h"] for r in df.select("i", murmur.murmur64(F.col("t")).alias("h")).orderBy("i").collect()]
    assert got == [None if t is None else plain_murmur(t.encode()) for t in texts]


@pytest.mark.parametrize(
    "start, end, unit, want",
    [("2023-01-01", "2024-03-01", "MONTH", 14), ("2023-01-31", "2023-02-01", "MONTH", 0), ("2023-01-01", "2023-01-11", "DAY", 10),
     ("2020-02-29", "2021-02-28", "YEAR", 0), ("2024-03-01", "2023-01-01", "MONTH", -14)],
)
def test_datediff(spark, start, end, unit, want):
    a, b = (F.lit(x).cast("date") for x in (start, end))
    assert spark.range(1).select(scalar.datediff_unit(a, b, unit)).first()[0] == want


def test_week_and_zone(spark):
    row = spark.range(1).select(
        scalar.week(F.lit("2023-01-01").cast("date")),
        scalar.from_unixtime_tz(F.lit(0).cast("bigint"), "yyyy-MM-dd HH:mm", "Asia/Shanghai"),
        scalar.from_unixtime_tz(F.lit(1700000000).cast("bigint"), "yyyy-MM-dd HH:mm:ss", "America/New_York"),
    ).first()
    assert tuple(row) == (52, "1970-01-01 08:00", "2023-11-14 17:13:20")


@pytest.mark.parametrize(
    "text, want",
    [("2023-01-02", "2023-01-02"), ("2023/01/02", "2023-01-02"), ("2023.01.02", "2023-01-02"), ("20230102", "2023-01-02"),
     ("2023年01月02日", "2023-01-02"), ("2023-01-02T03:04:05.123Z", "2023-01-02"), ("2023/1/2", "2023-01-02"),
     ("2023-02-30", None), ("02.01.2023", None), ("", None), (None, None), ("x2023-01-02", None)],
)
def test_dates(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(scalar.parse_date_auto(F.col("t")).cast("string")).first()[0] == want


@pytest.mark.parametrize("text, want", [("01:02:03", "01:02:03"), ("01:02:03.456", "01:02:03.456"), ("25:00:00", None), ("1:2:3", None), (None, None)])
def test_times(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(scalar.parse_time_auto(F.col("t"))).first()[0] == want


def test_nested_literals_unify(spark):
    row = spark.sql("select array(array(1, 2), array(3)) as a, map('x', map('y', 1L)) as m, typeof(array(1, 2L)) as t").first()
    assert row["a"] == [[1, 2], [3]] and row["m"]["x"]["y"] == 1 and row["t"] == "array<bigint>"


def test_sparse(spark):
    df = spark.sql("select map(0, 1.5f, 3, 2f) as m union all select cast(map() as map<int,float>) union all select null")
    got = [r[0] for r in df.select(vectors.sparse_to_dense(F.col("m"))).collect()]
    assert got == [[1.5, 0.0, 0.0, 2.0], [], None]
    for key in (-1, 1_000_001):
        with pytest.raises(Exception, match="sparse vector index"):
            spark.sql(f"select map({key}, 1f) as m").select(vectors.sparse_to_dense(F.col("m"))).collect()


@pytest.mark.parametrize("element, kind, fmt", [("float", "array<float>", ">f"), ("double", "array<double>", ">d"), ("int", "array<int>", ">i"), ("short", "array<smallint>", ">h")])
def test_pack(spark, element, kind, fmt):
    df = spark.createDataFrame([([1, -2, 3],), ([],), (None,), ([7],)], "v array<int>").select(F.col("v").cast(kind))
    packed = df.select("v", vectors.pack_vector(F.col("v"), element).alias("p"))
    for row in packed.collect():
        want = None if row["v"] is None else b"".join(struct.pack(fmt, x) for x in row["v"])
        assert (None if row["p"] is None else bytes(row["p"])) == want
    back = packed.select("v", vectors.unpack_vector(F.col("p"), element).alias("w"))
    assert all(r["v"] == r["w"] for r in back.collect())


def test_distances(spark):
    df = spark.sql("select array(3f, 4f) as a, array(0f, 0f) as z, array(4f, -3f) as b, X'0F' as x, X'3C' as y, cast(null as array<float>) as n")
    c = F.col
    row = df.select(
        vectors.l2_distance(c("a"), c("z")), vectors.inner_product(c("a"), c("b")), vectors.cosine_distance(c("a"), c("b")),
        vectors.cosine_distance(c("a"), c("z")), vectors.hamming_distance(c("x"), c("y")), vectors.jaccard_distance(c("x"), c("y")),
        vectors.l2_distance(c("a"), c("n")),
    ).first()
    assert tuple(row) == (5.0, 0.0, 1.0, None, 4, pytest.approx(1 - 2 / 6), None)


@pytest.mark.parametrize("metric", ["L2", "IP", "COSINE"])
@pytest.mark.parametrize("block_rows", [vectors.BLOCK_ROWS, 3])
def test_topk_against_brute_force(spark, metric, block_rows):
    rng = np.random.default_rng(0)
    corpus = rng.integers(-5, 6, (200, 3)).astype(float) + 0.5  # small integers make many ties
    corpus[:70] = corpus[0]  # a third of all rows is one vector
    wanted = rng.integers(-5, 6, (9, 3)).astype(float) + 0.5
    c = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(corpus)], "vec_id bigint, vector array<double>").repartition(5)
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(wanted)], "query_id bigint, vector array<double>")
    got = vectors.vector_topk(q, c, metric=metric, k=4, block_rows=block_rows)
    for i, query in enumerate(wanted):
        if metric == "L2":
            scores = np.sqrt(((corpus - query) ** 2).sum(1))
        elif metric == "IP":
            scores = -(corpus @ query)
        else:
            scores = 1 - corpus @ query / (np.linalg.norm(corpus, axis=1) * np.linalg.norm(query))
        best = sorted(range(200), key=lambda j: (round(scores[j], 9), j))[:4]
        mine = [r["vec_id"] for r in got.where(F.col("query_id") == i).orderBy("rank").collect()]
        assert [round(scores[j], 6) for j in mine] == [round(scores[j], 6) for j in best]
        if metric != "COSINE":
            assert mine == best


def test_bit_vectors_of_any_length(spark):
    flags = [[True] * 9, [False, True, True], [], None, [True, False] * 20]
    df = spark.createDataFrame([(i, f) for i, f in enumerate(flags)], "i int, f array<boolean>")
    packed = df.select("i", vectors.pack_bits(F.col("f")).alias("p"))
    want = [None if f is None else np.packbits(np.array(f, bool)).tobytes() for f in flags]
    assert [None if r["p"] is None else bytes(r["p"]) for r in packed.orderBy("i").collect()] == want
    flipped = df.select("i", vectors.pack_bits(F.transform("f", lambda x: ~x)).alias("q"))
    both = packed.join(flipped, "i").select("i", vectors.hamming_distance(F.col("p"), F.col("q")).alias("h"))
    assert [r["h"] for r in both.orderBy("i").collect()] == [9, 3, 0, None, 40]
    with pytest.raises(Exception, match="different lengths"):
        spark.sql("select X'00' as a, X'0000' as b").select(vectors.hamming_distance(F.col("a"), F.col("b"))).collect()


def test_topk_refuses_ragged_vectors(spark):
    schema = "id bigint, vector array<double>"
    one = spark.createDataFrame([(1, [1.0, 2.0])], schema)
    for other in ([(1, [1.0]), (2, [1.0, 2.0, 3.0])], [(1, [1.0, 2.0, 3.0])]):
        corpus = spark.createDataFrame(other, schema)
        with pytest.raises(Exception, match="different lengths"):
            vectors.vector_topk(one.toDF("query_id", "vector"), corpus.toDF("vec_id", "vector")).collect()
    nothing = spark.createDataFrame([(5, [0.0, 0.0]), (6, [1.0, 0.0])], schema).toDF("vec_id", "vector")
    got = vectors.vector_topk(one.toDF("query_id", "vector"), nothing, metric="COSINE").collect()
    assert [r.vec_id for r in got] == [6]
