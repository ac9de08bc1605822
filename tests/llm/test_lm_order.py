"""The language model of order three with all counted n-grams, against plain Python."""

import collections
import math
import os
import re
import zlib

import pytest

from millrace import session
from millrace.llm import lm
from millrace.llm.queries import op5_lm_scores
from workloads.registry import table


def _expected(texts: dict[int, str], discount: float = 0.75) -> dict[int, float]:
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = {i: [*re.findall(r"[^\x20\x09-\x0D]+", t.translate(lower)), None] for i, t in texts.items()}
    single, pair, triple = collections.Counter(), collections.Counter(), collections.Counter()
    for i, w in words.items():
        if zlib.crc32(str(i).encode()) % 10:
            single.update(w)
            pair.update(zip([None, *w[:-1]], w))
            triple.update(zip([None, *w[:-2]], w[:-1], w[1:]))
    kept2, kept3 = collections.Counter(), collections.Counter()
    for (a, _), c in pair.items():
        kept2[a] += c - discount
    for (a, b, _), c in triple.items():
        kept3[a, b] += c - discount
    n, v = sum(single.values()), len(single)

    def after(a, b, w, first):
        alone = (single[w] + 0.1) / (n + 0.1 * (v + 1))
        two = max(0, pair[b, w] - discount) / single[b] + (1 - kept2[b] / single[b]) * alone if single[b] else alone
        if first or not pair[a, b]:
            return two
        return max(0, triple[a, b, w] - discount) / pair[a, b] + (1 - kept3[a, b] / pair[a, b]) * two

    return {
        i: sum(
            math.log10(after(w[k - 2] if k > 1 else None, w[k - 1] if k else None, x, k == 0)) for k, x in enumerate(w)
        )
        for i, w in words.items()
    }


@pytest.mark.parametrize("small", [False, True])
def test_triples_and_singletons(spark, sf_dir, small):
    docs = table(spark, sf_dir, "documents")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    shards = {"words_per_shard": 2000, "pairs_per_shard": 10_000}
    got = lm.score_report(docs, settings=lm.Settings(order=3, **shards)) if small else op5_lm_scores(spark, sf_dir)
    expected = _expected(texts)
    for r in got.collect():
        assert abs(r.score - expected[r.doc_id]) <= 4e-4 * r.n_tokens


def test_grams_pass_one_shuffle(spark, tmp_path, monkeypatch):
    """What is stored besides the words is the level files alone, and contexts cut by their ends keep their weights."""
    texts = {i: " ".join(f"a w{(i * j) % 97} b w{j}" for j in range(60)) for i in range(200)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    monkeypatch.setattr(session, "scratch_root", lambda _: str(tmp_path))
    found = lm.score_report(docs, settings=lm.Settings(order=3, words_per_shard=50, pairs_per_shard=2000)).collect()
    made = collections.Counter(n.rsplit("-", 1)[0] for n in os.listdir(tmp_path))
    assert made == {"lm-counts": 1, "lm-words": 1, "lm-children": 2}
    for level in (n for n in os.listdir(tmp_path) if n.startswith("lm-children")):
        shards = lm._open(str(tmp_path / level))
        assert len(shards) > 5
    expected = _expected(texts)
    for r in found:
        assert abs(r.score - expected[r.doc_id]) <= 4e-4 * r.n_tokens
