"""Near duplicates in buckets too large for all pairs, against every pair that shares a bucket."""

import itertools
import random

from pyspark.sql import functions as F

from millrace.llm import neardup


def _group(n: int) -> list[str]:
    """Edited copies of one text: most have edits of their own, every third one repeats most edits of the copy before."""
    draw, base = random.Random(5), [f"w{i}" for i in range(300)]
    out, edits = [], {}
    for i in range(n):
        own = {draw.randrange(300): f"e{i}x{j}" for j in range(draw.randrange(2, 9))}
        edits = {**edits, draw.randrange(300): f"e{i}"} if i % 3 == 2 else own
        out.append(" ".join(edits.get(k, w) for k, w in enumerate(base)))
    return out


def _expected(spark, docs, texts: list[str], settings: neardup.Settings) -> dict[int, int]:
    """Classes by all pairs that share a band."""
    rows = docs.select(F.col("doc_id").alias("id"), "text")
    frequencies, n = neardup.document_frequencies(rows, settings)
    idf, shingler, sampler = neardup.idf_table(frequencies, n, settings.idf_strength), neardup.Shingler(settings.shingle), neardup.Sampler(settings)
    sets = [(h, neardup._weigh(h, c, idf, settings.df_bits)) for h, c in map(shingler, texts)]
    keys = [set(sampler.keys(*s).tolist()) for s in sets]
    parent = list(range(len(texts)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(range(len(texts)), 2):
        if keys[a] & keys[b] and neardup.weighted_jaccard(*sets[a], *sets[b]) >= settings.threshold:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {i: root(i) for i in range(len(texts))}


def test_members_meet_in_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL_BUCKET", 4)
    texts, settings = _group(300), neardup.Settings()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = _expected(spark, docs, texts, settings)
    assert 10 < len(set(expected.values())) < 290
    assert {r.id: r.class_id for r in neardup.near_duplicates(docs).collect()} == expected


def test_sketches_leave_out_pairs_that_cannot_be_similar(spark):
    """No pair of similar texts is lost, and texts that agree in most samples but differ in too many shingles make no pair."""
    texts, settings = _group(120), neardup.Settings()
    shingler = neardup.Shingler(settings.shingle)
    sets = [(h, (1.0 + neardup.np.log(c)) * 1.1) for h, c in map(shingler, texts)]
    same = [0] * (settings.bands * settings.rows)
    nodes = spark.createDataFrame(
        [(i, same, float(w.sum()), neardup.sketch(h).tolist()) for i, (h, w) in enumerate(sets)],
        "node long, prints array<short>, total double, sketch array<long>",
    )
    other = nodes.select(*[F.col(c).alias(f"other_{c}") for c in nodes.columns])
    met = nodes.crossJoin(other).where("node < other_node").where(neardup._may_be_similar(settings))
    found = {(r.node, r.other_node) for r in met.collect()}
    pairs = list(itertools.combinations(range(len(texts)), 2))
    similar = {(a, b) for a, b in pairs if neardup.weighted_jaccard(*sets[a], *sets[b]) >= settings.threshold}
    assert similar and similar <= found
    assert len(found) < len(pairs) * 3 / 4


def test_new_links_do_not_follow_old_ones_again(spark, monkeypatch):
    """After each round only the new links are closed; the classes are those of all links together."""
    monkeypatch.setattr(neardup, "SMALL_BUCKET", 4)
    followed, whole = [], neardup.components

    def counted(edges):
        followed.append(edges.count())
        return whole(edges)

    monkeypatch.setattr(neardup, "components", counted)
    texts, settings = _group(300), neardup.Settings()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.id: r.class_id for r in neardup.near_duplicates(docs).collect()} == _expected(spark, docs, texts, settings)
    assert len(followed) > 2 and all(n < followed[0] for n in followed[1:])


def test_merged_components(spark):
    labels = spark.createDataFrame([("a", "a"), ("b", "a"), ("d", "d"), ("e", "d")], "node string, label string")
    found = spark.createDataFrame([("b", "e"), ("e", "c"), ("x", "y"), ("a", "b")], "a string, b string")
    got = {(r.node, r.label) for r in neardup._merged(labels, found).collect()}
    assert got == {(n, "a") for n in "abcde"} | {("x", "x"), ("y", "x")}
