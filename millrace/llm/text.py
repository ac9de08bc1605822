"""Words and column names shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What the two word patterns of the result contracts leave between words. The words are the longest runs
# of all other characters.
PLAIN_GAP = r"[\x20\x09-\x0D]+"
FOLDED_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is. A pure ASCII text takes Spark's byte-wise ``lower``."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def _between(text: Column, gap: str) -> Column:
    """The runs of characters between gaps. Splitting at the gaps costs half of extracting the runs."""
    return F.array_remove(F.split(text, gap), "")


def plain_words(text: Column) -> Column:
    """Words between blanks; a null text has none."""
    return _between(F.coalesce(text, F.lit("")), PLAIN_GAP)


def folded_words(text: Column) -> Column:
    """Words of letters, digits and non-ASCII characters, A-Z in lower case; a null text has none."""
    return _between(ascii_lower(F.coalesce(text, F.lit(""))), FOLDED_GAP)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` computed once. An array kept this way stays a plain object for higher-order
    functions; one that passes through a column is packed, and reading single elements of it costs several times more."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unused(df: DataFrame, name: str) -> str:
    """``name``, prolonged until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


class WordHasher:
    """64-bit hashes of words. Each word is hashed once and remembered until ``room`` words are known; then the memory is
    emptied, so it stays bounded whatever the corpus holds."""

    def __init__(self, room: int = 300_000) -> None:
        self.room, self.known = room, {}

    def __call__(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > self.room:
            known.clear()
        try:
            return np.array([known[w] for w in words], dtype=np.uint64)
        except KeyError:
            for w in set(words).difference(known):
                known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
            return np.array([known[w] for w in words], dtype=np.uint64)
