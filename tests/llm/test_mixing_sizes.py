"""Mixing of sources whose words, times a weight, do not fit 32 bits while the words alone do."""

from collections import Counter

import pytest

from millrace.llm import mixing

COLUMNS = "doc_id long, text string, source string"


@pytest.fixture
def docs(spark):
    """Three sources of 40 documents with 1 to 23 words; none is so small that its target is cut."""
    rows = [(i, "word " * (1 + i * 7 % 23), "abc"[i % 3]) for i in range(120)]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


@pytest.fixture
def grown(monkeypatch):
    """Counts every word 2 ** 20 times: shares and sums stay exact, so the same documents are to be drawn."""
    sizes = mixing._sizes

    def many(*args):
        found = sizes(*args)
        return found.withColumn("size", found["size"] * 2**20)

    return lambda: monkeypatch.setattr(mixing, "_sizes", many)


@pytest.mark.parametrize("words", [10**6, 3 * 10**8, 10**9, 10**15])
def test_targets_of_many_words(spark, words):
    sizes = spark.createDataFrame([("a", words), ("b", words), ("c", words)], "source string, size long")
    got = {r.source: (r.source_size, r.target, r.rate) for r in mixing.source_targets(sizes).collect()}
    assert got == {s: (words, words * w / 2, w / 2) for s, w in zip("abc", (1, 2, 3))}


def test_targets_cut_by_repeats(spark):
    sizes = spark.createDataFrame([("a", 10**8), ("b", 5 * 10**8), ("c", 10**8)], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes, weights=(1, 1, 8)).collect()}
    assert got == {"a": 2.0e8, "b": 2.0e8, "c": 3.0e8}


def test_mix_of_many_words(docs, grown):
    few = Counter(mixing.mix(docs).collect())
    grown()
    assert Counter(mixing.mix(docs).collect()) == few
    total = mixing._sizes(docs, "doc_id", "text", "source").agg({"size": "sum"}).first()[0]
    assert total < 2**31 <= total * max(mixing.WEIGHTS)


def test_plan_of_many_words(docs, grown):
    few = Counter((r.doc_id, r.copies, r["size"] * 2**20, r.target * 2**20) for r in mixing.mix_plan(docs).collect())
    grown()
    plan = mixing.mix_plan(docs).collect()
    assert Counter((r.doc_id, r.copies, r["size"], r.target) for r in plan) == few
    assert all(r.taken == r.copies * r["size"] for r in plan)
