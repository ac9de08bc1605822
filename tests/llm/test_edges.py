"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import pytest
from pyspark.sql import functions as F

from millrace.llm import chat, decontaminate, lm, mixing, neardup, quality, tokens, toxicity, warc
from tests.conftest import rows

CLEAN = "the house by the river and the old mill were for many years the home of a quiet family with three children"
LONG = " ".join(f"word{i} of the" for i in range(20_000))
# Column names that the operators use inside.
CLASH = "n_words, words, h, row, id, node, copies, size, source_size, q_words, mix_rate, kept, score, label, text_of"


@pytest.fixture(scope="module")
def docs(spark):
    data = [
        (1, CLEAN, "a"), (1, CLEAN, "a"), (2, CLEAN, "b"), (3, None, "a"), (4, "", None), (None, "no id here", "a"),
        (5, LONG, "b"), (6, "  \n\t ", None), (None, None, None), (7, "one", "a"), (8, CLEAN + " again", "b"),
    ]
    base = spark.createDataFrame(data, "doc_id long, text string, source string")
    return base.withColumns({name.strip(): F.lit(0) for name in CLASH.split(",")})


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def benchmark(spark):
    items = [(10, CLEAN), (10, CLEAN), (None, "old mill were for many years the home of a quiet"), (11, None), (12, "")]
    items += [(13, "One!"), (14, "mill were for")]
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("limit", [decontaminate.MAX_BROADCAST_BYTES, -1])
def test_decontaminate(docs, benchmark, limit):
    found = decontaminate.contamination(docs, benchmark, max_broadcast_bytes=limit)
    got = {(r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids)) for r in found.collect()}
    n = len(CLEAN.split())
    assert found.count() == docs.count()
    assert (1, n, n, ("10", "14")) in got
    assert (8, n + 1, n, ("10", "14")) in got
    assert (7, 1, 1, ("13",)) in got
    assert {(3, 0, 0, ()), (4, 0, 0, ()), (None, 0, 0, ()), (None, 3, 0, ()), (5, 60_000, 0, ())} <= got


def test_decontaminate_empty(docs, empty, benchmark):
    assert decontaminate.contamination(empty, benchmark).count() == 0
    assert decontaminate.contamination(docs, benchmark.limit(0)).where("contaminated").count() == 0


def test_keep_clean(docs, benchmark):
    kept = decontaminate.keep_clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {3, 4, 5, 6, None}


def test_quality(docs, empty):
    report = quality.quality_report(docs)
    assert report.count() == docs.count()
    by = {r.doc_id: r for r in report.collect() if r.doc_id is not None}
    assert by[1].kept and by[5].n_words == 60_000
    assert [by[k].kept for k in (3, 4, 6, 7)] == [False] * 4
    assert all(by[k].base_failed for k in (3, 4, 6, 7))
    assert quality.quality_report(empty).count() == 0
    kept = quality.keep_by_quality(docs)
    assert kept.columns == docs.columns and kept.where("doc_id = 1").count() == 2


def test_quality_windows(spark):
    again = "a b c d e x a b c d e y z"
    got = quality.quality_report(spark.createDataFrame([(1, again), (2, "s " * 9)], "doc_id long, text string"))
    assert {r.doc_id: r.n_repeat_words for r in got.collect()} == {1: 10, 2: 9}


def test_mixing(docs, empty):
    plan = mixing.mix_plan(docs)
    assert plan.count() == docs.count()
    assert plan.where("copies > 3 OR copies < 0").count() == 0
    assert rows(plan) == rows(mixing.mix_plan(docs))
    assert mixing.mix_plan(empty).count() == 0
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == plan.agg(F.sum("copies")).first()[0]
    assert mixing.mix(empty).count() == 0


def test_mixing_targets(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 5), (None, 0)], "source string, size long")
    got = {r.source: (r.source_size, r.target) for r in mixing.source_targets(sizes).collect()}
    assert got["a"] == (10, 30.0) and got["c"] == (5, 15.0) and got[None] == (0, 0.0)
    assert got["b"] == (1000, 970.0)


def test_toxicity(spark, docs, empty):
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (3, None), (None, 1), (5, 0), (7, 1), (7, 0)], "doc_id long, toxic int"
    )
    for seen in (labels, labels.limit(0)):
        model = toxicity.train(toxicity.learning_rows(docs, seen))
        scored = toxicity.with_score(docs.drop("score"), model)
        assert scored.where("score BETWEEN 0 AND 1").count() == docs.count()
    assert toxicity.with_score(empty.drop("score"), model).count() == 0
    assert toxicity.keep_harmless(docs, labels.limit(0)).columns == docs.columns


def test_near_duplicates(docs, empty):
    found = {(r.id, r.class_id) for r in neardup.near_duplicates(docs).collect()}
    assert {(1, 1), (2, 1), (8, 1), (3, 3), (4, 4), (5, 5), (7, 7)} <= found
    assert neardup.near_duplicates(empty).count() == 0
    kept = neardup.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 3, 4, 5, 6, 7] and ids.count(None) == 2


def test_lm(docs, empty):
    scored = lm.score_report(docs)
    assert scored.count() == docs.count()
    by = {r.doc_id: r for r in scored.collect() if r.doc_id is not None}
    assert by[3].n_tokens == by[4].n_tokens == by[6].n_tokens == 1 and by[5].n_tokens == 60_001
    assert all(r.score < 0 and r.base_score < 0 for r in by.values())
    assert lm.score_report(empty).count() == 0


def test_tokens(docs, empty):
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    report = tokens.token_report(docs, path)
    by = {r.doc_id: r for r in report.collect() if r.doc_id is not None}
    assert report.count() == docs.count()
    assert by[3].n_tokens == by[4].n_tokens == by[3].n_bytes == 0
    assert by[5].over_limit and not by[1].over_limit
    assert tokens.token_report(empty, path).count() == 0


def test_chat(spark):
    data = [
        (1, 0, "system", "be kind"), (1, 1, "user", None), (1, 2, "assistant", "x </turn>\n### y \\"), (1, 2, "assistant", "b"),
        (None, 0, "assistant", "alone"), (2, None, None, "no role"), (2, 1, "a\\l\nb#", "\\{ <\\\\"), (3, 0, "assistant", ""),
    ]
    turns = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    turns = turns.withColumns({c: F.lit(1) for c in ("place", "window", "conv", "span", "tokens", "history")})
    read = chat.read_chat(chat.format_chat(turns))
    got = {r.conv_id: ([tuple(t) for t in r.turns], r.learnt) for r in read.collect()}
    assert got[1] == (
        [("system", "be kind"), ("user", ""), ("assistant", "b"), ("assistant", "x </turn>\n### y \\")],
        ["b", "x </turn>\n### y \\"],
    )
    assert got[None] == ([("assistant", "alone")], ["alone"])
    assert got[2] == ([("", "no role"), ("a\\l\nb#", "\\{ <\\\\")], [])
    assert got[3] == ([("assistant", "")], [""])
    assert chat.format_chat(turns.limit(0)).count() == 0


def test_chat_windows(spark):
    data = [(1, 0, "system", "s " * 5)] + [(1, i, ("user", "assistant")[i % 2], f"w{i} " * 20) for i in range(1, 41)]
    turns = spark.createDataFrame(data, "conv_id long, turn int, role string, text string")
    budget = chat.Budget(tokens=200, history=50)
    windows = chat.format_chat(turns, budget=budget)
    assert windows.count() > 4
    # No window is over the budget, all after the first repeat the system turn and some history.
    for r in windows.collect():
        pieces = r.formatted.split(chat.CLOSE)[:-1]
        assert sum(len(p.split("\n", 1)[1].split()) + budget.per_turn for p in pieces) <= budget.tokens
        assert pieces[0].startswith("### system") and (r.n_repeated > 1) == (r.window > 0)
    report = chat.chat_report(windows).first()
    assert report.n_turns == 41 and report.loss_chars == sum(len(d[3]) for d in data if d[2] == "assistant")


def test_warc(spark, tmp_path):
    data = [(1, "http://a/ b", "x"), (2, None, "x"), (3, "u", None), (4, "u", ""), (None, "u", "é\r\n\r\nWARC/1.0"), (5, "u", "x" * 9_000_000)]
    pages = spark.createDataFrame([*data, (5, "u", "y"), (5, "u", "y")], "page_id long, url string, html string")
    pages = pages.withColumns({c: F.lit(1) for c in ("name", "content", "page", "payload")})
    archives = warc.written(warc.arc_archives(pages), "arc")
    path = str(tmp_path / "warc")
    warc.write_warc(warc.with_revisits(warc.convert_arc(archives)), path, records_per_file=2)
    got = sorted((r.page or "", r.payload_bytes, r.record_type, r.refers_to_page or "") for r in warc.read_warc(spark, path).collect())
    assert got == [
        ("", 14, "response", ""), ("1", 1, "revisit", "2"), ("2", 1, "response", ""), ("3", 0, "revisit", "4"), ("4", 0, "response", ""),
        ("5", 1, "response", ""), ("5", 1, "revisit", "5"), ("5", 9_000_000, "response", ""),
    ]
    assert warc.arc_archives(pages.limit(0)).count() == 0


def test_arc_versions():
    for version in (1, 2):
        block = f"{version} 0 org\n{warc.ARC_TITLES[version]}\n".encode()
        head = warc._arc_line(version, "n", 0, "filedesc://n", "text/plain", block, "20010203040506")
        one = warc._arc_line(version, "n", 9, "http://x/", "text/html", b"HTTP/1.0 200 OK\r\n\r\nbody\nmore", "20010203040506")
        (fields, body), = warc.parse_arc(head + one)
        assert fields["url"] == "http://x/" and fields["date"] == "20010203040506" and body.endswith(b"body\nmore")
        with pytest.raises(ValueError):
            list(warc.parse_arc(head + one[:-9]))
    with pytest.raises(ValueError):
        list(warc.parse_arc(b"filedesc://n 0.0.0.0 2001 text/plain 2\n9 \n"))
    assert list(warc.parse_arc(b"")) == []
