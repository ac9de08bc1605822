"""Alignment of two tokenizers over the same bytes.

Both token rows of a text are half-open byte intervals. All of them are sorted by start with one ``lexsort``; a running
maximum of their ends tells where a group of tokens closes: at a start that reaches the maximum. Inside the groups the
overlapping pairs are expanded. Whole batches of texts are handled as one line of bytes, so no Python loop visits an
interval.

How often a pair of ids is linked over the whole corpus is counted in Spark: tasks put out a document's distinct pairs
with their numbers, these are summed by pair, and the sums are joined back to the documents. The table of sums is broadcast
only where its counted rows are few; beyond that Spark shuffles and, where a pair is in most documents, splits it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bytelevel import byte_level_encoder, byte_letters
from millrace.llm.text import unused
from millrace.session import written

BLANK = "▁"  # fixed value: how the piece vocabulary writes a blank

# A count table of so many rows is broadcast, at about 60 bytes a row in memory.
MAX_BROADCAST_PAIRS = 1_000_000
# Characters of text that are aligned at once; one longer text is aligned alone.
CHUNK = 1_000_000


@dataclass(frozen=True)
class Tokens:
    """One side: the ids of texts, and the bytes each id stands for."""

    encode: Callable[[list[str]], list[list[int]]]
    pieces: list[bytes]


@lru_cache(maxsize=2)
def byte_level(path: str) -> Tokens:
    """A byte-level vocabulary (``.json``). It encodes a blank and the text; special strings are ordinary text."""
    from tokenizers import Tokenizer

    entries, letters = Tokenizer.from_file(path).get_vocab(), byte_letters()
    pieces = [b""] * (max(entries.values()) + 1)
    for entry, i in entries.items():
        plain = all(c in letters for c in entry)
        pieces[i] = bytes(letters[c] for c in entry) if plain else entry.encode()
    encode = byte_level_encoder(path, specials=False)
    return Tokens(lambda texts: encode([f" {t}" for t in texts]), pieces)


@lru_cache(maxsize=2)
def byte_fallback(path: str) -> Tokens:
    """A piece vocabulary with byte fallback (``.model``), which puts a blank before the text itself."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)

    def piece(i: int) -> bytes:
        text = model.id_to_piece(i)
        return bytes([int(text[1:-1], 16)]) if model.is_byte(i) else text.replace(BLANK, " ").encode()

    return Tokens(lambda texts: model.encode(texts, num_threads=1), [piece(i) for i in range(model.vocab_size())])


def groups_of(starts: np.ndarray, ends: np.ndarray, sides: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of intervals by start, and in that order the group of each. A group closes where the next start reaches the
    largest end so far."""
    order = np.lexsort((sides, starts))
    if not len(order):
        return order, order
    reach = np.maximum.accumulate(ends[order])
    opens = starts[order][1:] >= reach[:-1]
    return order, np.concatenate([[0], np.cumsum(opens)])


def overlaps(a_starts: np.ndarray, a_ends: np.ndarray, b_starts: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (place in A, place in B) of overlapping intervals; each side is gapless and in order, so the partners of
    an interval are a run of the other side."""
    first = np.searchsorted(b_ends, a_starts, side="right")
    many = np.searchsorted(b_starts, a_ends, side="left") - first
    a = np.repeat(np.arange(len(a_starts)), many)
    within = np.arange(len(a)) - np.repeat(np.cumsum(many) - many, many)
    return a, np.repeat(first, many) + within


class Aligner:
    """Alignments of batches of texts by two sides."""

    def __init__(self, a: Tokens, b: Tokens) -> None:
        self.a, self.b, self.width = a, b, len(b.pieces)
        self.lengths = [np.array([len(p) for p in side.pieces], dtype=np.int64) for side in (a, b)]
        # Written forms of ids: the mark before an id tells whether it opens a group, its group's B side, or goes on.
        self.names, self.base = [], {}
        for use, mark, side in (("a", ",", a), ("a opens", ";", a), ("b", ",", b), ("b opens", "|", b)):
            self.base[use] = len(self.names)
            self.names += [f"{mark}{i}" for i in range(len(side.pieces))]

    def tokens(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides; none where the bytes of a side are not a blank and the text."""
        a, b = self.a.encode(texts), self.b.encode(texts)
        for k, text in enumerate(texts):
            whole = b" " + text.encode("utf-8", "surrogatepass")
            if not text or any(
                b"".join(map(side.pieces.__getitem__, ids)) != whole for side, ids in ((self.a, a[k]), (self.b, b[k]))
            ):
                a[k], b[k] = [], []
        return a, b

    def __call__(self, texts: list[str | None]) -> dict[str, list | np.ndarray]:
        """Columns of a batch: the number of tokens, groups and links of each text, its written groups, and its distinct
        linked pairs (``a * width + b``) with how often it links them, text by text."""
        a, b = self.tokens([t or "" for t in texts])
        n = len(texts)
        ids, docs, starts, ends = [], [], [], []
        for side, lengths in zip((a, b), self.lengths):
            count = np.array([len(x) for x in side], dtype=np.int64)
            own = np.fromiter(chain.from_iterable(side), dtype=np.int64, count=int(count.sum()))
            end = np.cumsum(lengths[own])
            ids.append(own), docs.append(np.repeat(np.arange(n), count)), starts.append(end - lengths[own]), ends.append(end)
        n_a, n_b = (np.bincount(d, minlength=n) for d in docs)
        sides = np.repeat([0, 1], [len(ids[0]), len(ids[1])])
        order, group = groups_of(np.concatenate(starts), np.concatenate(ends), sides)
        doc_of = np.concatenate(docs)[order]
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else group
        n_groups = np.bincount(doc_of[first], minlength=n)

        at_a, at_b = overlaps(starts[0], ends[0], starts[1], ends[1])
        n_links = np.bincount(docs[0][at_a], minlength=n)
        key = ids[0][at_a] * self.width + ids[1][at_b]
        span = len(self.a.pieces) * self.width
        pairs, times = np.unique(docs[0][at_a] * span + key, return_counts=True)
        return {
            "n_a": n_a,
            "n_b": n_b,
            "n_groups": n_groups,
            "n_links": n_links,
            "groups": self._written(ids, sides[order], order, group, doc_of, n),
            "pairs": pairs % span,
            "times": times,
            "n_pairs": np.bincount(pairs // span, minlength=n),
        }

    def _written(self, ids, side, order, group, doc_of, n) -> list[str]:
        """Groups of each text as ``a1,a2|b1;a3|b2,b3``."""
        if not len(order):
            return [""] * n
        by_side = np.lexsort((np.arange(len(order)), side, group))  # a group's A tokens before its B tokens
        side, group, doc_of = side[by_side], group[by_side], doc_of[by_side]
        token = np.concatenate(ids)[order][by_side]
        opens_group = np.append(True, group[1:] != group[:-1])
        opens_side = opens_group | np.append(True, side[1:] != side[:-1])
        base = np.where(
            side == 0,
            np.where(opens_group, self.base["a opens"], self.base["a"]),
            np.where(opens_side, self.base["b opens"], self.base["b"]),
        )
        names = list(map(self.names.__getitem__, (base + token).tolist()))
        cuts = np.searchsorted(doc_of, np.arange(n + 1)).tolist()
        return ["".join(names[i:j])[1:] for i, j in zip(cuts, cuts[1:])]


@lru_cache(maxsize=1)
def shared_aligner(a_path: str, b_path: str) -> Aligner:
    """One aligner for all tasks that a Python worker runs."""
    return Aligner(byte_level(a_path), byte_fallback(b_path))


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= CHUNK:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def alignments(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``n_a``, ``n_b``, ``n_groups``, ``n_links`` (long), ``groups`` (written
    ``a1,a2|b1;a3|b2,b3`` in ids), and the text's distinct linked pairs: ``pairs`` (A id times ``width`` plus B id, where
    ``width`` is the size of the B vocabulary) with ``times``, how often the text links each.

    Row-local. The vocabulary files lie at the same paths on every executor. Null and empty texts, and texts a side does
    not give back byte for byte, have no tokens: zeros, an empty string and empty arrays. Repeated rows and null ids stay
    as they are; other columns play no part; no rows give no rows. A long text is aligned whole, in one task.
    """
    only = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    id_type = only.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = shared_aligner(a_path, b_path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, j in _chunks(texts):
                out = align(texts[i:j])
                cuts = pa.array(np.concatenate([[0], np.cumsum(out["n_pairs"])]).astype(np.int32))
                counts = [pa.array(out[k], pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_links")]
                groups = pa.array(out["groups"], pa.string())
                pairs = pa.ListArray.from_arrays(cuts, pa.array(out["pairs"], pa.int64()))
                times = pa.ListArray.from_arrays(cuts, pa.array(out["times"], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(i, j - i), *counts, groups, pairs, times],
                    names=["id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"],
                )

    schema = f"id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"
    return only.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """How often each pair is linked over all rows of ``alignments``: ``pair``, ``count``, and ``best``, whether no A id is
    linked more often with its B id. Sums are combined before the shuffle; the best per B id are at most ``width`` rows,
    which bounds what is broadcast."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("e"))
    counts = written(each.groupBy(F.col("e.pairs").alias("pair")).agg(F.sum("e.times").alias("count")), "pair-counts")
    b = F.pmod("pair", F.lit(width))
    best = counts.groupBy(b.alias("b")).agg(F.max("count").alias("most"))
    joined = counts.join(F.broadcast(best), b == F.col("b"))
    return joined.select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def with_links(aligned: DataFrame, width: int, max_broadcast: int = MAX_BROADCAST_PAIRS) -> DataFrame:
    """``aligned`` (rows of ``alignments``, with any further columns, but without ``groups`` if it need not be stored) with
    ``n_best``, its links whose pair is counted highest for its B id, and ``count_sum``, the counts over its links. The
    alignment is written once; counting and looking up read it back. Rows without links get zeros."""
    row, best_col, sum_col = (unused(aligned, n) for n in ("row", "n_best", "count_sum"))
    stored = written(aligned.withColumn(row, F.monotonically_increasing_id()), "alignments")
    counts = written(pair_counts(stored, width), "pair-best")
    if counts.count() <= max_broadcast:
        counts = F.broadcast(counts)
    each = stored.select(row, F.explode(F.arrays_zip("pairs", "times")).alias("e"))
    each = each.select(F.col(row).alias("at"), F.col("e.pairs").alias("pair"), F.col("e.times").alias("times"))
    sums = (
        each.join(counts, "pair")
        .groupBy("at")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias(best_col),
            F.sum(F.col("times") * F.col("count")).alias(sum_col),
        )
    )
    joined = stored.join(sums, F.col(row) == F.col("at"), "left").drop(row, "at")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast("long")) for c in (best_col, sum_col)})
