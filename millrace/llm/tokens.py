"""Token counts of a byte-pair vocabulary by rank-synchronous merging.

Texts are cut where no piece can reach across (before a run of blanks). The distinct parts of a batch lie in one ragged
numpy array of symbols; in each round every part applies its lowest-rank pair, all parts at once, until no pair of any
part is a piece. What survives is counted. Counts of short parts are remembered between batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import unused

BLANK = "▁"  # fixed value: how the vocabulary writes a blank
TOKEN_LIMIT = 4096
_NONE = np.iinfo(np.int64).max
_PARTS = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")


class Vocabulary:
    """The merge table of a vocabulary file: every way to put a piece together from two pieces, with its rank.

    Ranks follow the scores, best first. A character that is no piece itself counts as its UTF-8 bytes."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.size = model.vocab_size()
        ids = [i for i in range(self.size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        pieces = {model.id_to_piece(i): i for i in ids}
        score = {i: model.get_score(i) for i in ids}
        rank = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        if any(BLANK in p.lstrip(BLANK) for p in pieces):
            raise ValueError("a piece has a blank inside: texts cannot be cut before blanks")
        symbol = dict(pieces)
        for letter in sorted({c for p in pieces for c in p} - pieces.keys()):
            symbol[letter] = len(symbol) + self.size  # a letter of pieces that is no piece
        self.width = max(symbol.values()) + 1
        table, eager = {}, set()
        for piece, i in pieces.items():
            for cut in range(1, len(piece)):
                a, b = symbol.get(piece[:cut]), symbol.get(piece[cut:])
                if a is not None and b is not None:
                    table[a * self.width + b] = (rank[score[i]], i)
                    # Joining a part that ranks behind the whole could open a better pair at once.
                    eager.update(x for x in (a, b) if x in score and score[x] < score[i])
        self.keys = np.array(sorted(table), dtype=np.int64)
        found = [table[k] for k in self.keys.tolist()]
        self.ranks = np.array([r for r, _ in found], dtype=np.int64)
        self.merged = np.array([m for _, m in found], dtype=np.int64)
        self.one_by_one = np.zeros(self.width, dtype=bool)
        self.one_by_one[list(eager)] = True
        self.letters = np.full(0x110000, -1, dtype=np.int32)
        for text, i in symbol.items():
            if len(text) == 1:
                self.letters[ord(text)] = i

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of pairs of symbols; ``_NONE`` where they make no piece."""
        key = np.where((left >= 0) & (right >= 0), left * self.width + right, -1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], _NONE), self.merged[at]

    def count(self, parts: list[str]) -> np.ndarray:
        """How many symbols survive in each part (none of them empty)."""
        lengths = np.array([len(p) for p in parts], dtype=np.int64)
        codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        symbols = self.letters[codes].astype(np.int64)
        utf8 = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
        cost = np.where((symbols >= 0) & (symbols < self.size), 1, utf8)
        part = np.repeat(np.arange(len(parts)), lengths)
        out = np.zeros(len(parts), dtype=np.int64)
        inside = np.append(part[1:] == part[:-1], False)
        right = np.append(symbols[1:], -1)
        ranks, merged = self.lookup(symbols, np.where(inside, right, -1))
        while len(symbols):
            starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            sizes = np.diff(np.append(starts, len(part)))
            best = np.minimum.reduceat(ranks, starts)
            open_ = best != _NONE
            if not open_.all():  # parts without a pair are done
                out[part[starts[~open_]]] = np.add.reduceat(cost, starts)[~open_]
                keep = np.repeat(open_, sizes)
                symbols, cost, part, ranks, merged = (x[keep] for x in (symbols, cost, part, ranks, merged))
                best, sizes = best[open_], sizes[open_]
                if not len(symbols):
                    break
            at = np.flatnonzero(ranks == np.repeat(best, sizes))
            first = np.append(True, part[at[1:]] != part[at[:-1]])
            # All places of a part's best pair at once, from the left and without overlap; only the first one where the
            # new piece may open a better pair.
            run = np.flatnonzero(np.append(True, at[1:] != at[:-1] + 1) | first)
            odd = (np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))) % 2 == 1
            at = at[first | (~odd & ~self.one_by_one[merged[at]])]
            symbols[at], cost[at] = merged[at], 1
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            moved = at - np.arange(len(at))  # each merge before a place takes one symbol away
            symbols, cost, part, ranks, merged = (x[keep] for x in (symbols, cost, part, ranks, merged))
            touched = np.unique(np.concatenate([moved, moved[moved > 0] - 1]))
            after = np.minimum(touched + 1, len(symbols) - 1)
            same = (after > touched) & (part[after] == part[touched])
            ranks[touched], merged[touched] = self.lookup(symbols[touched], np.where(same, symbols[after], -1))
        return out


class Counter:
    """Token counts of texts. Remembers the counts of parts of up to ``longest`` characters, ``room`` of them at most."""

    def __init__(self, vocabulary: Vocabulary, room: int = 500_000, longest: int = 40, chunk: int = 1_000_000) -> None:
        self.vocabulary, self.room, self.longest, self.chunk, self.known = vocabulary, room, longest, chunk, {}

    def __call__(self, texts: list[str | None]) -> list[int]:
        out, waiting, size = [], [], 0
        for text in texts:
            waiting.append(text or "")
            size += len(waiting[-1])
            if size >= self.chunk:
                out += self._count(waiting)
                waiting, size = [], 0
        return out + self._count(waiting)

    def _count(self, texts: list[str]) -> list[int]:
        cut = [_PARTS.findall(f"{BLANK}{t.replace(' ', BLANK)}") if t else [] for t in texts]
        if len(self.known) > self.room:
            self.known.clear()
        known = self.known
        fresh = list({p for parts in cut for p in parts}.difference(known))
        counts = dict(zip(fresh, self.vocabulary.count(fresh).tolist())) if fresh else {}
        known.update((p, n) for p, n in counts.items() if len(p) <= self.longest)
        return [sum(known[p] if p in known else counts[p] for p in parts) for parts in cut]


@lru_cache(maxsize=1)
def shared_counter(path: str) -> Counter:
    """One counter for all tasks that a Python worker runs."""
    return Counter(Vocabulary(path))


def with_token_count(docs: DataFrame, path: str, text_col: str = "text", count_col: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of tokens of each whole text under the vocabulary file at ``path``, which every executor
    has. Row-local; a null or empty text has none; markers and special strings in a text are ordinary text."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = shared_counter(path)
        for batch in batches:
            yield pd.Series(counter(batch.tolist()), dtype="int64")

    return docs.withColumn(count_col, count(F.col(f"`{text_col}`").cast("string")))


def token_report(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = TOKEN_LIMIT
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes`` of UTF-8, ``n_tokens``, ``over_limit``. Repeated rows and null ids are
    kept as they are; other columns play no part; no rows give no rows."""
    only = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").cast("string").alias(unused(docs, "own_text")))
    text = only.columns[1]
    counted = with_token_count(only, path, text, "n_tokens")
    return counted.select(
        id_col,
        F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
