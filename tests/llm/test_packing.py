"""Packing: every id in exactly one piece, gapless sequences, no padding; the tree against a plain first fit."""

import collections
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm import packing
from millrace.llm.queries import op13_pack_sequences
from workloads.registry import table

PATH = public_tokenizers.path("byte_bpe_50k.json")


def encoded(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]


def check_sequences(pieces, capacity):
    """``pieces``: (sequence, offset, length). Returns the lengths of the sequences."""
    by_sequence = collections.defaultdict(list)
    for sequence, offset, length in pieces:
        assert length > 0
        by_sequence[sequence].append((offset, length))
    lengths = []
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity and at & (at - 1) == 0
        lengths.append(at)
    return lengths


def test_whole_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    ids = dict(zip(texts, encoded(texts.values())))
    rows = op13_pack_sequences(spark, sf_dir).collect()
    check_sequences([(r.sequence_id, r.offset, r.length) for r in rows], 1024)
    at = collections.Counter()
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert (r.start, r.doc_tokens) == (at[r.doc_id], len(ids[r.doc_id]))
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(piece, dtype="<u4").tobytes())
        at[r.doc_id] += r.length
    assert at == {i: len(x) for i, x in ids.items()}


@pytest.mark.parametrize("group", [3, 1000])
def test_hard_texts(spark, group):
    texts = ["", None, "a", "<|endoftext|> once", "日本語 " * 50, "word " * 5000, "x" * 20_000, *["same text"] * 40, *[f"text {i} " * i for i in range(60)]]
    docs = spark.createDataFrame([(i % 5 or None, t, i, 0) for i, t in enumerate(texts)], "doc_id long, text string, block long, ids int")
    pieces = packing.packed_pieces(docs, PATH, capacity=64, group=group).collect()
    lengths = check_sequences([(r.sequence_id, r.offset, r.length) for r in pieces], 64)
    assert sum(lengths) == sum(map(len, encoded(texts)))
    want = collections.Counter((i % 5 or None, tuple(x)) for i, x in enumerate(encoded(texts)))
    # Rows of one id are told apart by their ids: pieces are put together in every way that fits.
    found = collections.Counter()
    by_doc = collections.defaultdict(lambda: collections.defaultdict(list))
    for r in pieces:
        part = tuple(np.frombuffer(r.ids, dtype="<u4").tolist())
        assert len(part) == r.length
        by_doc[r.doc_id, r.doc_tokens][r.start].append(part)
    for (doc, n), starts in by_doc.items():
        assert sum(len(p) for parts in starts.values() for p in parts) % n == 0
        for whole in [x for (d, x) in want if d == doc and len(x) == n]:
            for start, parts in starts.items():
                found[doc, whole] += sum(len(p) for p in parts if whole[start : start + len(p)] == p)
    for (doc, whole), times in want.items():
        assert found[doc, whole] >= times * len(whole)


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(i, f"some words {i} " * (i + 1)) for i in range(30)], "doc_id long, text string")
    rows = packing.sequences(packing.packed_pieces(docs, PATH, capacity=32)).collect()
    assert all(len(r.ids) == 4 * r.length for r in rows)
    found = collections.Counter(np.concatenate([np.frombuffer(r.ids, dtype="<u4") for r in rows]).tolist())
    assert found == collections.Counter(i for x in encoded(f"some words {i} " * (i + 1) for i in range(30)) for i in x)


def test_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.packed_pieces(none, PATH).count() == 0
    with pytest.raises(ValueError):
        packing.packed_pieces(none, PATH, capacity=1000)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_tree_finds_the_first_fit(lengths):
    lengths.sort(reverse=True)
    rooms, want = [], []
    for n in lengths:
        at = next((i for i, room in enumerate(rooms) if room >= n), len(rooms))
        if at == len(rooms):
            rooms.append(64)
        rooms[at] -= n
        want.append(at)
    assert packing.first_fit(lengths, 64) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 63), max_size=60))
def test_group(lengths):
    places = packing.pack_group(np.arange(len(lengths)), np.array(lengths, dtype=np.int64), 64)
    sizes = check_sequences(zip(places.bin, places.offset, places.length), 64)
    assert sum(s < 64 for s in sizes) <= 6
    for block, own in places.groupby("block"):
        own = own.sort_values("cut")
        assert own.cut.tolist() == [0, *np.cumsum(own.length)[:-1]] and own.length.sum() == lengths[block]
    assert set(places.block) == set(range(len(lengths)))
