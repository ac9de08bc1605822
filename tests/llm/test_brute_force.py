"""Operators SQL cannot express, against plain Python over the whole small tables."""

import collections
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from millrace.llm import lm, neardup, tokens, toxicity
from workloads.registry import table


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r.doc_id: r.text or "" for r in table(spark, sf_dir, "documents").collect()}


def test_near_duplicates(spark, sf_dir, texts):
    sets = {}
    for i, text in texts.items():
        words = re.findall(r"\w+", text.lower())
        k = min(5, len(words))
        sets[i] = {tuple(words[j : j + k]) for j in range(len(words) - k + 1)} if k else set()
    found = {r.id: r.class_id for r in neardup.near_duplicates(table(spark, sf_dir, "documents")).collect()}
    for a, b in itertools.combinations(sets, 2):
        common = len(sets[a] & sets[b])
        similarity = common / max(1, len(sets[a] | sets[b]))
        if similarity >= 0.85:  # the operator weighs shingles: near the threshold it may differ
            assert found[a] == found[b]
    groups = collections.defaultdict(list)
    for i, c in found.items():
        groups[c].append(i)
    for c, members in groups.items():
        assert c == min(members)
        for i in members if len(members) > 1 else []:
            assert any(len(sets[i] & sets[j]) >= 0.75 * len(sets[i] | sets[j]) for j in members if j != i)


@pytest.mark.parametrize("settings", [lm.Settings(), lm.Settings(words_per_shard=2000, pairs_per_shard=10_000)])
def test_lm(spark, sf_dir, texts, settings):
    ascii_lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = {i: [*re.findall(r"[^\x20\x09-\x0D]+", t.translate(ascii_lower)), None] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    single, pair = collections.Counter(), collections.Counter()
    for i, w in words.items():
        if not held[i]:
            single.update(w)
            pair.update(zip([None, *w[:-1]], w))
    n, v, d = sum(single.values()), len(single), settings.discount
    kept = collections.Counter()
    for (a, _), c in pair.items():
        kept[a] += c - d if c >= settings.min_count else 0
    alone = lambda w: (single[w] + 0.1) / (n + 0.1 * (v + 1))

    def after(a, w):
        share = (pair[a, w] - d) / single[a] if pair[a, w] >= settings.min_count else 0.0
        return share + (1 - kept[a] / single[a] if kept[a] else 1.0) * alone(w)

    for r in lm.score_report(table(spark, sf_dir, "documents"), settings=settings).collect():
        w = words[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(w), n)
        assert r.n_known == sum(x in single for x in w)
        assert math.isclose(r.base_score, sum(math.log10(alone(x)) for x in w), rel_tol=1e-9)
        exact = sum(math.log10(after(a, x)) for a, x in zip([None, *w[:-1]], w))
        assert abs(r.score - exact) <= 2e-4 * len(w)


def test_elias_fano():
    rng = np.random.default_rng(1)
    for n, top in ((1, 1), (5, 3), (1000, 900), (5000, 1 << 40), (3000, 1 << 62)):
        values = np.sort(rng.integers(0, top, n, dtype=np.uint64))
        built = lm.EliasFano.build(values)
        ef = lm.EliasFano(*(built[k] for k in ("n", "shift", "low", "bits", "ones")))
        assert (ef.access(np.arange(n)) == values).all()
        asked = np.concatenate([values, rng.integers(0, top, 500, dtype=np.uint64)])
        at, hit = ef.successor(asked, np.zeros(len(asked), dtype=np.int64), np.full(len(asked), n))
        assert (hit == np.isin(asked, values)).all() and (values[at[hit]] == asked[hit]).all()


def test_tokens(texts):
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    rng = random.Random(5)
    odd = ["".join(rng.choice("aab  cthe▁inr\n\té😀漢<s></s>0x\0À") for _ in range(rng.randint(1, 90))) for _ in range(800)]
    odd += [None, "", " ", "▁", "<s></s><unk>", "x" * 5000, "the" * 900, " " * 700, "ab" * 3000]
    all_texts = [*texts.values(), *odd]
    expected = [len(x) for x in SentencePieceProcessor(model_file=path).encode([t or "" for t in all_texts])]
    assert tokens.Counter(tokens.Vocabulary(path))(all_texts) == expected


def test_toxicity(spark):
    """Held-out accuracy where there is enough to learn from."""
    folder = "/root/testdata/sf0.1"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.train(toxicity.learning_rows(docs, labels))
    scored = toxicity.with_score(docs.where(toxicity.held_out("doc_id")), model).join(labels, "doc_id")
    got = collections.Counter((r.toxic, r.score >= 0.3) for r in scored.select("toxic", "score").collect())
    assert got[1, True] >= 0.7 * (got[1, True] + got[1, False])
    assert got[0, True] <= 0.02 * (got[0, True] + got[0, False])
    assert len(model.index) < 1 << 15


def test_pipeline(spark, sf_dir, texts):
    """Each stage against what its operator says of the stage's own input."""
    from millrace.llm.decontaminate import contamination
    from millrace.llm.mixing import mix_plan
    from millrace.llm.quality import quality_report
    from millrace.session import written

    docs = table(spark, sf_dir, "documents")
    ids = lambda df: collections.Counter(r.doc_id for r in df.select("doc_id").collect())
    expected = {
        "quality rules": lambda d: ids(quality_report(d).where("kept")),
        "decontamination": lambda d: ids(contamination(d, table(spark, sf_dir, "benchmark")).where("NOT contaminated")),
        "near-dedup": lambda d: collections.Counter(r.class_id for r in neardup.near_duplicates(d).select("class_id").distinct().collect()),
        "mixing": lambda d: collections.Counter({r.doc_id: r.copies for r in mix_plan(d).where("copies > 0").collect()}),
    }
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, sf_dir), "stage")
        assert out.columns == docs.columns
        if name in expected:
            assert ids(out) == expected[name](docs), name
        docs = out
    assert ids(corpus_pipeline.run(spark, sf_dir)) == ids(docs)
