"""Alignment of two tokenizers against an interval-by-interval version."""

import collections
import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from millrace.llm import align
from millrace.llm.queries import op11_token_alignment
from workloads.registry import table

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))

HARD = ["", None, " ", "  two  blanks ", "naïve 日本語 🙂🙂", "<|endoftext|> <s> <0x41>", "a▁b", "tab\tnew\nline\r", "x" * 5000, "é" * 300]


def spans(ids, side):
    at, out = 0, []
    for i in ids:
        out.append((i, at, at + len(side.pieces[i])))
        at = out[-1][2]
    return out


def brute(texts):
    a_side, b_side = align.byte_level(A), align.byte_fallback(B)
    rows, counts = [], collections.Counter()
    for text in texts:
        whole = (" " + (text or "")).encode()
        a, b = a_side.encode([text])[0] if text else [], b_side.encode([text])[0] if text else []
        if any(b"".join(s.pieces[i] for i in ids) != whole for s, ids in ((a_side, a), (b_side, b))):
            a, b = [], []
        a, b = spans(a, a_side), spans(b, b_side)
        links, j = [], 0
        for i, s, e in a:
            while j and b[j - 1][2] > s:
                j -= 1
            while j < len(b) and b[j][2] <= s:
                j += 1
            k = j
            while k < len(b) and b[k][1] < e:
                links.append((i, b[k][0]))
                k += 1
        cuts = sorted({x[2] for x in a} & {x[2] for x in b})
        parts, last = [], 0
        for cut in cuts:
            inside = [",".join(str(i) for i, s, e in side if last <= s and e <= cut) for side in (a, b)]
            parts.append("|".join(inside))
            last = cut
        rows.append((len(a), len(b), len(cuts), links, ";".join(parts)))
        counts.update(links)
    most = collections.Counter()
    for (_, i), n in counts.items():
        most[i] = max(most[i], n)
    for n_a, n_b, n_groups, links, groups in rows:
        n_best = sum(counts[x] == most[x[1]] for x in links)
        digest = hashlib.sha256(groups.encode()).hexdigest() if n_a else ""
        yield n_a, n_b, n_groups, len(links), n_best, sum(counts[x] for x in links), digest


def test_whole_table(spark, sf_dir):
    texts = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    found = {r.doc_id: tuple(r[n] for n in names) for r in op11_token_alignment(spark, sf_dir).collect()}
    assert found == {i: row for (i, _), row in zip(texts, brute([t for _, t in texts]))}


@pytest.mark.parametrize("limit", [align.MAX_BROADCAST_PAIRS, 0])
def test_hard_texts(spark, limit, monkeypatch):
    monkeypatch.setattr(align, "CHUNK", 50)
    docs = spark.createDataFrame([(i % 7 if i != 3 else None, t, "x", 1) for i, t in enumerate(HARD + HARD)], "doc_id long, text string, row string, n_best int")
    aligned = align.alignments(docs, A, B)
    out = align.with_links(aligned, 32000, limit).withColumn("d", F.when(F.col("n_a") > 0, F.sha2(F.col("groups"), 256)).otherwise(""))
    found = sorted(tuple(r) for r in out.select("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "d").collect())
    assert found == sorted(brute(HARD + HARD))
    assert any(r[0] for r in found) and sum(r[0] == 0 for r in found) >= 6


def test_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert align.with_links(align.alignments(none, A, B), 32000).count() == 0


def test_groups_close_where_a_start_reaches_the_running_end():
    import numpy as np

    starts, ends = np.array([0, 3, 0, 2, 3]), np.array([3, 5, 2, 3, 5])
    order, group = align.groups_of(starts, ends, np.array([0, 0, 1, 1, 1]))
    assert [(int(starts[i]), int(g)) for i, g in zip(order, group)] == [(0, 0), (0, 0), (2, 0), (3, 1), (3, 1)]
