"""Language-model scoring with an Elias-Fano n-gram trie.

The model is an interpolated n-gram model of order two or three over all words of the training texts. Its levels are files in the shared
scratch folder, written by Spark tasks over sorted ranges and memory-mapped by the tasks that score:

* words: their hashes (Elias-Fano) and exact counts; a word's number is its rank,
* children: for each context from a file's first to its last its quantised backoff weight and a pointer (Elias-Fano,
  monotone) to its words, whose numbers are made monotone by adding the last value of the context before (Elias-Fano), and
  their quantised probabilities. A context is found by its number. One that is cut by the end of a file has its weight from
  the heads of all files it is in.

A child is found by a successor search relative to its context's base. ``p(w | v)`` is the discounted share of ``w``
after ``v``, if that pair was seen ``min_count`` times, plus ``backoff(v) * p(w)``; ``p(w)`` is the smoothed share of
``w`` among all tokens. With order three, ``p(w | u v)`` is in the same way the discounted share of ``w`` after the pair
``u v`` plus ``backoff(u v) * p(w | v)``; its levels are those of the pairs again, with the number of a stored pair as the
context, and the first word of a text has the end before it as its only context. Counts cover all training texts; what
is seen less than ``min_count`` times is left to the backoff weight, which takes what it had, so the probabilities after
a context sum to 1 up to quantisation.
"""

from __future__ import annotations

import json
import mmap
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.text import ascii_lower, plain_words
from millrace.session import scratch_dir, written

_SEED = 42  # fixed value: what Spark's xxhash64 starts from
_SIGN = np.uint64(1 << 63)


@dataclass(frozen=True)
class Settings:
    """``min_count`` is how often a pair or triple must be seen to be stored, ``discount`` what each stored one gives up.
    ``order`` is the length of the longest n-grams, 2 or 3."""

    min_count: int = 1
    order: int = 2
    discount: float = 0.75
    smoothing: float = 0.1
    words_per_shard: int = 500_000
    pairs_per_shard: int = 2_000_000


# --- Elias-Fano sequences ------------------------------------------------------------------------------------------

_ODD, _PAIRS, _NIBBLES, _BYTES, _TOPS = (np.uint64(x * 0x0101010101010101) for x in (0x55, 0x33, 0x0F, 0x01, 0x80))


def _places_in_byte() -> np.ndarray:
    """The place of the k-th one of a byte, at ``k * 256 + byte``."""
    places = np.zeros((8, 256), dtype=np.uint64)
    for byte in range(256):
        for k, place in enumerate(i for i in range(8) if byte >> i & 1):
            places[k, byte] = place
    return places.reshape(-1)


_IN_BYTE = _places_in_byte()


def _in_word(bits: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The place of the k-th (from 0) one of each word. All arrays are uint64."""
    sums = bits - ((bits >> np.uint64(1)) & _ODD)
    sums = (sums & _PAIRS) + ((sums >> np.uint64(2)) & _PAIRS)
    sums = ((sums + (sums >> np.uint64(4))) & _NIBBLES) * _BYTES  # each byte: the ones up to its end
    shift = np.bitwise_count(((k * _BYTES | _TOPS) - sums) & _TOPS).astype(np.uint64) << np.uint64(3)
    k = k - ((sums << np.uint64(8)) >> shift & np.uint64(255))
    return shift + _IN_BYTE[(k << np.uint64(8)) | (bits >> shift & np.uint64(255))]


class EliasFano:
    """A monotone sequence of whole numbers: low parts as they are, high parts in unary in a bit vector.

    The width of the low parts is rounded to whole bytes that numpy can read in place."""

    def __init__(
        self, n: int, shift: int, low: np.ndarray, bits: np.ndarray, ones: np.ndarray, zeros: np.ndarray | None = None
    ) -> None:
        self.n, self.shift, self.low, self.bits, self.ones = n, np.uint64(shift), low, bits, ones
        self.zeros = self._zeros(ones) if zeros is None else zeros

    @staticmethod
    def _zeros(ones: np.ndarray) -> np.ndarray:
        return (np.arange(len(ones), dtype=np.int64) * 64 - ones).astype(np.uint32)

    @staticmethod
    def build(values: np.ndarray) -> dict[str, np.ndarray | int]:
        """The arrays of a sequence (uint64, ascending, repeats allowed)."""
        n, top = len(values), int(values[-1]) if len(values) else 0
        ideal = max(0, (top // max(n, 1)).bit_length() - 1)
        shift = next((w for w in (8, 16, 32) if ideal <= w + 3), 48) if ideal > 3 else 0
        kind = {0: np.uint8, 8: np.uint8, 16: np.uint16, 32: np.uint32, 48: np.uint64}[shift]
        high = (values >> np.uint64(shift)).astype(np.int64)
        places = high + np.arange(n)
        flags = np.zeros((int(places[-1]) if n else 0) // 64 * 64 + 128, dtype=np.uint8)
        flags[places] = 1
        bits = np.packbits(flags, bitorder="little").view(np.uint64)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(bits))]).astype(np.uint32)
        low = (values & np.uint64((1 << shift) - 1)).astype(kind) if shift else np.zeros(0, dtype=np.uint8)
        return {"n": n, "shift": shift, "low": low, "bits": bits, "ones": ones, "zeros": EliasFano._zeros(ones)}

    def _select(self, k: np.ndarray, one: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The place of the k-th (from 0) one or zero, its word, and that word (of zeros: its complement)."""
        before = self.ones if one else self.zeros
        word = np.searchsorted(before, k.astype(before.dtype), side="right") - 1
        bits = self.bits[word] if one else ~self.bits[word]
        at = _in_word(bits, (k - before[word]).astype(np.uint64))
        return word * 64 + at.astype(np.int64), word, bits

    def _select_two(self, k: np.ndarray, one: bool) -> tuple[np.ndarray, np.ndarray]:
        """The places of the k-th and of the next one or zero, mostly by one search."""
        place, word, bits = self._select(k, one)
        rest = bits & ~((np.uint64(2) << (place & 63).astype(np.uint64)) - np.uint64(1))
        following = word * 64 + np.bitwise_count(~rest & (rest - np.uint64(1))).astype(np.int64)
        if len(far := np.flatnonzero(rest == 0)):
            following[far] = self._select(k[far] + 1, one)[0]
        return place, following

    def _value(self, i: np.ndarray, place: np.ndarray) -> np.ndarray:
        high = (place - i).astype(np.uint64) << self.shift
        return high | self.low[i].astype(np.uint64) if self.shift else high

    def access(self, i: np.ndarray) -> np.ndarray:
        return self._value(i, self._select(i, True)[0])

    def access_two(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values at ``i`` and behind it."""
        place, following = self._select_two(i, True)
        return self._value(i, place), self._value(i + 1, following)

    def successor(self, x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each value the only place in ``lo`` to ``hi`` (exclusive) that may hold it, and whether it does."""
        high = (x >> self.shift).astype(np.int64)
        zeros = int(self.zeros[-1])
        inside = high < zeros  # beyond the last zero no element can lie
        h = np.minimum(high, zeros - 1)
        before = np.maximum(h - 1, 0)
        place, following = self._select_two(before, False)
        start = np.where(h > 0, place - before, 0)
        end = np.where(h > 0, following, place) - h
        a, b = np.maximum(lo, start), np.minimum(hi, end)
        there = inside & (a < b)
        if not self.shift:
            return a, there
        wanted = (x & np.uint64((1 << int(self.shift)) - 1)).astype(self.low.dtype)
        of = np.flatnonzero(there & (b - a > 1))
        first, behind = a[of], b[of]
        while len(of):  # to the last place that holds no more
            middle = (first + behind) >> 1
            more = self.low[middle] > wanted[of]
            first, behind = np.where(more, first, middle), np.where(more, middle, behind)
            a[of] = first
            open_ = np.flatnonzero(behind - first > 1)
            of, first, behind = of[open_], first[open_], behind[open_]
        held = np.flatnonzero(there)
        there[held] = self.low[a[held]] == wanted[held]
        return a, there


# --- Level files ---------------------------------------------------------------------------------------------------


_ARRAYS = ("low", "bits", "ones", "zeros")


def pack(meta: dict, parts: dict[str, dict | np.ndarray]) -> bytes:
    """One level file: a line of JSON that says what is where, then the arrays, each at a multiple of 8 bytes."""
    arrays, table = [], {}
    for name, part in parts.items():
        if isinstance(part, dict):
            table[name] = {"n": part["n"], "shift": part["shift"]}
            arrays += [(f"{name}.{k}", part[k]) for k in _ARRAYS]
        else:
            arrays.append((name, part))
    at, layout = 0, {}
    for name, array in arrays:
        layout[name] = [at, len(array), array.dtype.str]
        at += -(-array.nbytes // 8) * 8
    head = json.dumps({"meta": meta, "sequences": table, "layout": layout}).encode("ascii")
    head += b" " * (-(len(head) + 1) % 8) + b"\n"
    return head + b"".join(a.tobytes() + b"\0" * (-a.nbytes % 8) for _, a in arrays)


class Shard:
    """A level file, memory-mapped."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            data = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        end = data.find(b"\n") + 1
        head = json.loads(data[:end])
        self.meta, self.arrays = head["meta"], {}
        for name, (at, n, kind) in head["layout"].items():
            self.arrays[name] = np.frombuffer(data, dtype=np.dtype(kind), count=n, offset=end + at)
        for name, x in head["sequences"].items():
            self.arrays[name] = EliasFano(x["n"], x["shift"], *(self.arrays[f"{name}.{k}"] for k in _ARRAYS))


def write_level(shards: DataFrame, path: str) -> None:
    """The column ``file`` as raw files at ``path``, one for each row (the line break at the end does no harm)."""
    text = shards.select(F.col("file").cast("string").alias("value"))
    text.write.option("maxRecordsPerFile", 1).text(path)


def published(spark: SparkSession, path: str) -> str:
    """``path`` as executors find it: as it is on a mounted file system, else as a copy that Spark hands to each."""
    if urlparse(path).scheme in ("", "file"):
        return urlparse(path).path
    spark.sparkContext.addFile(path, recursive=True)
    return f"spark-files:{os.path.basename(path)}"


def _open(path: str) -> list[Shard]:
    if path.startswith("spark-files:"):
        path = SparkFiles.get(path.removeprefix("spark-files:"))
    names = sorted(n for n in os.listdir(path) if n.startswith("part-"))
    found = [Shard(os.path.join(path, n)) for n in names if os.path.getsize(os.path.join(path, n))]
    return sorted(found, key=lambda s: s.meta["first"])


class _Ranges:
    """Shards by the first key of each; queries are sorted and dealt to them."""

    def __init__(self, path: str) -> None:
        self.shards = _open(path)
        self.first = np.array([s.meta["first"] for s in self.shards], dtype=np.uint64)

    def deal(self, keys: np.ndarray) -> Iterator[tuple[int, Shard, slice]]:
        """For ascending keys: number and shard, and the slice of the keys that it may hold."""
        cuts = np.append(np.searchsorted(keys, self.first, side="left"), len(keys))
        for k, shard in enumerate(self.shards):
            if cuts[k] < cuts[k + 1]:
                yield k, shard, slice(cuts[k], cuts[k + 1])


_P1, _P2, _P3, _P4, _P5 = (  # fixed values: the primes of XXH64
    np.uint64(x)
    for x in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
)


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return x << np.uint64(by) | x >> np.uint64(64 - by)


def word_hashes(words: pa.Array) -> np.ndarray:
    """What Spark's ``xxhash64`` gives for each word, unsigned: all words at once by numpy, those of 32 bytes or more one by
    one by the library."""
    wide = pa.types.is_large_string(words.type)
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[words.offset : words.offset + len(words) + 1]
    begin, size = ends[:-1].astype(np.int64), np.diff(ends).astype(np.int64)
    raw = bytes(data or b"") + b"\0" * 8
    eights, fours = (np.ndarray(len(raw) - 7, dtype=kind, buffer=raw, strides=(1,)) for kind in ("<u8", "<u4"))
    single = np.frombuffer(raw, dtype=np.uint8)
    h = np.uint64(_SEED) + _P5 + size.astype(np.uint64)
    for k in range(3):
        of = np.flatnonzero(size >= 8 * (k + 1))
        h[of] = _turn(h[of] ^ _turn(eights[begin[of] + 8 * k] * _P2, 31) * _P1, 27) * _P1 + _P4
    of = np.flatnonzero(size & 4)
    h[of] = _turn(h[of] ^ fours[begin[of] + (size[of] & ~7)].astype(np.uint64) * _P1, 23) * _P2 + _P3
    for k in range(3):
        of = np.flatnonzero((size & 3) > k)
        h[of] = _turn(h[of] ^ single[begin[of] + (size[of] & ~3) + k].astype(np.uint64) * _P5, 11) * _P1
    h = (h ^ h >> np.uint64(33)) * _P2
    h = (h ^ h >> np.uint64(29)) * _P3
    h ^= h >> np.uint64(32)
    for i in np.flatnonzero(size >= 32).tolist():
        h[i] = xxhash.xxh64_intdigest(raw[begin[i] : begin[i] + size[i]], seed=_SEED)
    return h


class Words(_Ranges):
    """The word level: numbers and counts of words. The last number stands for the end of a text."""

    def __init__(self, path: str, ends: int, settings: Settings) -> None:
        super().__init__(path)
        sizes = np.array([s.meta["n"] for s in self.shards], dtype=np.int64)
        self.offset = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.end, self.ends = int(self.offset[-1]), ends
        self.distinct = self.end + (ends > 0)
        self.total = ends + sum(s.meta["total"] for s in self.shards)
        self.smoothing = settings.smoothing

    def numbers(self, words: pa.Array) -> np.ndarray:
        """The numbers of words, -1 for those no training text has."""
        raw = word_hashes(words) ^ _SIGN
        order = np.argsort(raw)
        keys, found = raw[order], np.full(len(raw), -1, dtype=np.int64)
        for k, shard, part in self.deal(keys):
            n = np.full(part.stop - part.start, shard.meta["n"], dtype=np.int64)
            # Hashes are kept relative to the shard's first one.
            at, hit = shard.arrays["hash"].successor(keys[part] - self.first[k], np.zeros_like(n), n)
            found[part] = np.where(hit, at + self.offset[k], -1)
        numbers = np.empty_like(found)
        numbers[order] = found
        return numbers

    def counts(self, numbers: np.ndarray) -> np.ndarray:
        """How often the words of these ascending numbers were seen; 0 for -1."""
        out = np.where(numbers == self.end, self.ends, 0).astype(np.int64)
        _gather_counts(self, numbers, out)
        return out

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return (counts + self.smoothing) / (self.total + self.smoothing * (self.distinct + 1))

    def coded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All tokens of the texts, each text followed by an end, as places in a list of numbers; that list; and how many
        tokens each text has."""
        # Arrow's blanks are those of the contract. Of a text without words it makes one empty word.
        trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
        words = pc.ascii_split_whitespace(trimmed)
        empty = pc.equal(pc.binary_length(trimmed), 0).to_numpy(zero_copy_only=False)
        lengths = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + ~empty
        flat = words.flatten()
        if empty.any():
            flat = flat.filter(pc.not_equal(pc.binary_length(flat), 0))
        found = flat.dictionary_encode()
        codes = np.full(int(lengths.sum()), len(found.dictionary), dtype=np.int64)
        inside = np.ones(len(codes), dtype=bool)
        inside[np.cumsum(lengths) - 1] = False
        codes[inside] = found.indices.to_numpy()
        return codes, np.append(self.numbers(found.dictionary), self.end), lengths

    def chain(self, texts: pa.Array) -> np.ndarray:
        """The numbers of all tokens of the texts, each text followed by an end."""
        codes, numbers, _ = self.coded(texts)
        return numbers[codes]

    def before(self, chain: np.ndarray) -> np.ndarray:
        """The token before each, an end before the first."""
        return np.concatenate([[self.end], chain[:-1]])


def _gather_counts(level: Words | Children, numbers: np.ndarray, out: np.ndarray) -> None:
    """Into ``out`` the counts of ascending numbers, of those that lie in a shard."""
    cuts = np.searchsorted(numbers, level.offset, side="left")
    for k, shard in enumerate(level.shards):
        if cuts[k] < cuts[k + 1]:
            part = slice(cuts[k], cuts[k + 1])
            out[part] = shard.arrays["count"][numbers[part] - level.offset[k]]


_QUANTA = 65535
_FLOOR = -12.0


def _quantise(log10: np.ndarray) -> np.ndarray:
    return np.round((np.clip(log10, _FLOOR, 0.0) / _FLOOR) * _QUANTA).astype(np.uint16)


_SHARES = 10.0 ** (np.arange(_QUANTA + 1) * (_FLOOR / _QUANTA))


def _restore(q: np.ndarray) -> np.ndarray:
    return _SHARES[q]


def _parted(keys: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Context and word of keys. (``np.divmod`` takes several times as long.)"""
    context = keys // width
    return context, keys - context * width


def _backoff(kept: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The quantised backoff weights of contexts, of what their children keep and of how often the contexts were seen."""
    return _quantise(np.log10(np.maximum(1.0 - kept / total, 1e-9)))


class Children(_Ranges):
    """A level of children: their shares, by keys of context and word, and the backoff weights of the contexts. A child's
    number is its rank among the keys."""

    def __init__(self, path: str, width: int) -> None:
        super().__init__(path)
        self.width = width
        self.offset = np.concatenate([[0], np.cumsum([s.meta["n"] for s in self.shards])]).astype(np.int64)
        self.first_context = np.array([s.meta["first_context"] for s in self.shards], dtype=np.int64)
        kept, totals = {}, {}
        for shard in self.shards:
            for context, part, total in shard.meta["edges"]:
                kept[context], totals[context] = kept.get(context, 0.0) + part, total
        self.edges = np.array(sorted(kept), dtype=np.int64)
        self.edge_weights = _backoff(np.array([kept[c] for c in sorted(kept)]), np.array([totals[c] for c in sorted(kept)]))

    def find(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The discounted share and the number of ascending, distinct children; 0 and -1 for those that are not stored."""
        out, numbers = np.zeros(len(word)), np.full(len(word), -1, dtype=np.int64)
        for k, shard, part in self.deal((context * self.width + word).astype(np.uint64)):
            pointers, child = shard.arrays["pointer"], shard.arrays["child"]
            at = context[part] - shard.meta["first_context"]
            stored = int(np.searchsorted(at, pointers.n - 1))  # those after it begin behind the last context
            if not stored:
                continue
            at = at[:stored]
            fresh = np.append(True, at[1:] != at[:-1])
            begin, end = (x.astype(np.int64) for x in pointers.access_two(at[fresh]))
            base = np.where(begin > 0, child.access(np.maximum(begin - 1, 0)), np.uint64(0))
            of = np.cumsum(fresh) - 1
            wanted = word[part][:stored].astype(np.uint64) + base[of]
            place, there = child.successor(wanted, begin[of], end[of])
            hit, place = np.flatnonzero(there) + part.start, place[there]
            out[hit] = _restore(shard.arrays["share"][place])
            numbers[hit] = place + self.offset[k]
        return out, numbers

    def counts(self, numbers: np.ndarray) -> np.ndarray:
        """How often the children of these ascending numbers were seen after their context."""
        out = np.zeros(len(numbers), dtype=np.int64)
        _gather_counts(self, numbers, out)
        return out

    def weights(self, contexts: np.ndarray) -> np.ndarray:
        """The backoff weight of ascending contexts; 1 for those without children and for -1."""
        out = np.ones(len(contexts))
        cuts = np.append(np.searchsorted(contexts, self.first_context, side="left"), len(contexts))
        for k, shard in enumerate(self.shards):
            if cuts[k] < cuts[k + 1]:
                held = shard.arrays["weight"]
                at = contexts[cuts[k] : cuts[k + 1]] - self.first_context[k]
                at = at[: np.searchsorted(at, len(held))]
                out[cuts[k] : cuts[k] + len(at)] = _restore(held[at])
        if len(self.edges):
            at = np.minimum(np.searchsorted(self.edges, contexts), len(self.edges) - 1)
            of = self.edges[at] == contexts
            out[of] = _restore(self.edge_weights[at[of]])
        return out

    def look_up(
        self, context: np.ndarray, word: np.ndarray, weigh: bool = True
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """Shares and numbers of children in any order, 0 and -1 where one is not stored or context or word is -1, and the
        weights of their contexts if asked for."""
        span = self.width + 1
        distinct, of = np.unique(np.where(context >= 0, context * span + word + 1, -1), return_inverse=True)
        context, word = _parted(distinct, span)
        word -= 1
        share, number = np.zeros(len(distinct)), np.full(len(distinct), -1, dtype=np.int64)
        known = (context >= 0) & (word >= 0)
        share[known], number[known] = self.find(context[known], word[known])
        return share[of], number[of], self.weights(context)[of] if weigh else None


def _pairs_before(words: Words, chain: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """For each token of a chain, given the numbers of all pairs, the number of the pair before it; -1 where that is unknown,
    and for the first token of a text."""
    inside = np.concatenate([[False], chain[:-1] != words.end])
    return np.where(inside, np.concatenate([[-1], numbers[:-1]]), -1)


class Trie:
    """The whole model as a scoring task sees it; the last two levels are those of triples."""

    def __init__(self, words: str, levels: tuple[str, ...], ends: int, settings: Settings) -> None:
        self.words = Words(words, ends, settings)
        width = self.words.end + 1
        self.children = [Children(p, width) for p in levels]

    def score(self, texts: pa.Array) -> dict[str, np.ndarray]:
        """Token counts and log10 probabilities of texts."""
        codes, numbers, lengths = self.words.coded(texts)
        chain, order, counts = numbers[codes], np.argsort(numbers), np.empty_like(numbers)
        counts[order] = self.words.counts(numbers[order])
        alone = self.words.probability(counts)
        share, pair, weight = self.children[0].look_up(self.words.before(chain), chain)
        whole = share + weight * alone[codes]
        if len(self.children) > 1:
            share, _, weight = self.children[1].look_up(_pairs_before(self.words, chain, pair), chain)
            whole = share + weight * whole
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        return {
            "n_tokens": lengths,
            "n_known": np.add.reduceat((counts > 0)[codes].astype(np.int64), starts),
            "base_score": np.add.reduceat(np.log10(alone)[codes], starts),
            "score": np.add.reduceat(np.log10(whole), starts),
        }


@lru_cache(maxsize=1)
def _words(path: str, ends: int, settings: Settings) -> Words:
    return Words(path, ends, settings)


@lru_cache(maxsize=1)
def _children(path: str, width: int) -> Children:
    return Children(path, width)


@lru_cache(maxsize=1)
def _trie(words: str, levels: tuple[str, ...], ends: int, settings: Settings) -> Trie:
    return Trie(words, levels, ends, settings)


def _chunks(texts: pa.Array, size: int = 8_000_000) -> Iterator[pa.Array]:
    """Slices of a batch that keep memory bounded, of about ``size`` bytes; a longer text is in a slice of its own or ends
    one. Large ones find more words and n-grams repeated, and open fewer files for each token."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        done = int(ends[at - 1]) if at else 0
        to = min(int(np.searchsorted(ends, done + size)) + 1, len(texts))
        yield texts.slice(at, to - at)
        at = to


# --- Training ------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """``levels``: the children of pairs, and with order three those of triples."""

    words: str
    levels: tuple[str, ...]
    ends: int
    tokens: int
    settings: Settings


def _sorted_ranges(df: DataFrame, key: str, parts: int) -> DataFrame:
    return df.repartitionByRange(max(1, parts), key).sortWithinPartitions(key)


def _whole(batches: Iterator[pd.DataFrame]) -> pd.DataFrame | None:
    """A partition, which a range of bounded size makes bounded."""
    parts = [b for b in batches if len(b)]
    return pd.concat(parts, ignore_index=True) if parts else None


def _word_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows = _whole(batches)
    if rows is not None:
        keys = rows["key"].to_numpy().view(np.uint64) ^ _SIGN
        counts = rows["n"].to_numpy()
        meta = {"first": int(keys[0]), "n": len(keys), "total": int(counts.sum())}
        small = np.uint32 if counts.max() < 1 << 32 else np.uint64
        yield pd.DataFrame({"file": [pack(meta, {"hash": EliasFano.build(keys - keys[0]), "count": counts.astype(small)})]})


def train(texts: DataFrame, settings: Settings = Settings()) -> Model:
    """A model of the column ``text``. Counts cover all rows; a null text is an empty one; repeated rows count each time.
    Words are told apart by a 64-bit hash. Without rows everything is unknown."""
    spark = texts.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    counted = (
        texts.select(F.explode(plain_words(ascii_lower(text))).alias("word"))
        .groupBy(F.xxhash64("word").alias("key"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counted = written(counted, "lm-counts")
    size = counted.agg(F.count(F.lit(1)).alias("words"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")).first()
    ends = texts.count()
    tokens = size["tokens"] + ends
    words = scratch_dir(spark, "lm-words")
    parts = -(-size["words"] // settings.words_per_shard)
    write_level(_sorted_ranges(counted, "key", parts).mapInPandas(_word_files, "file binary"), words)
    here = published(spark, words)
    only, levels, width = texts.select(text.alias("text")), (), size["words"] + 1
    for _ in range(settings.order - 1):
        path = scratch_dir(spark, "lm-children")
        write_level(_child_files(only, here, levels[:1], ends, tokens, width, settings), path)
        levels += (published(spark, path),)
    return Model(here, levels, ends, tokens, settings)


def _gram_keys(
    batches: Iterator[pa.RecordBatch], words: str, pairs: tuple[str, ...], ends: int, settings: Settings
) -> Iterator[np.ndarray]:
    """The keys of all pairs of the texts, or of all triples if the level of pairs is given, some millions at a time."""
    own, waiting, size = _words(words, ends, settings), [], 0
    width = own.end + 1
    for batch in batches:
        for part in _chunks(batch.column("text")):
            chain = own.chain(part)
            context = own.before(chain)
            if pairs:
                context = _pairs_before(own, chain, _children(*pairs, width).look_up(context, chain, weigh=False)[1])
            known = (context >= 0) & (chain >= 0)
            waiting.append(context[known] * width + chain[known])
            size += len(waiting[-1])
            if size >= 3_000_000:
                yield np.concatenate(waiting)
                waiting, size = [], 0
    if size:
        yield np.concatenate(waiting)


def _cuts(
    texts: DataFrame, words: str, pairs: tuple[str, ...], ends: int, shards: int, settings: Settings
) -> np.ndarray:
    """Where ranges of keys begin, after the first one: about ``shards`` ranges with as many keys each, by those of a part of
    the texts. They say only which file a key is in; one number for each range comes back."""
    share = min(16, shards // 4)
    if share > 1:
        texts = texts.where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0)

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys in _gram_keys(batches, words, pairs, ends, settings):
            yield pa.RecordBatch.from_pydict({"key": np.unique(keys)})

    if shards < 2:
        return np.zeros(0, dtype=np.int64)
    at = F.array(*(F.lit(k / shards) for k in range(1, shards)))
    found = texts.mapInArrow(some, "key long").agg(F.percentile_approx("key", at, max(10_000, 20 * shards))).first()[0]
    return np.unique(np.array(found or [], dtype=np.int64))


def _child_files(
    texts: DataFrame, words: str, pairs: tuple[str, ...], ends: int, tokens: int, width: int, settings: Settings
) -> DataFrame:
    """The files of the level of pairs, or of triples if the level of pairs is given, with what is seen ``min_count`` times.

    Tasks send sorted, packed blocks of what they have counted, dealt by ranges of keys, and each range becomes a file, so
    counts pass one shuffle and are not stored in between. A context with many children may lie in several files."""
    shards, discount = max(1, -(-tokens // settings.pairs_per_shard)), settings.discount
    cuts = _cuts(texts, words, pairs, ends, shards, settings)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _gram_keys(batches, words, pairs, ends, settings):
            keys, counts = np.unique(found, return_counts=True)
            bounds = [0, *np.searchsorted(keys, cuts, side="left").tolist(), len(keys)]
            rows = [(k, slice(a, b)) for k, (a, b) in enumerate(zip(bounds, bounds[1:])) if a < b]
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([k for k, _ in rows], pa.int32()),
                    "keys": pa.array([_pack_ascending(keys[at]) for _, at in rows], pa.binary()),
                    "counts": pa.array([_pack_planes(counts[at].astype(np.uint32)) for _, at in rows], pa.binary()),
                }
            )

    def totals(contexts: np.ndarray) -> np.ndarray:
        return _children(*pairs, width).counts(contexts) if pairs else _words(words, ends, settings).counts(contexts)

    def file(group: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([_unpack_ascending(x) for x in group["keys"]])
        counts = np.concatenate([_unpack_planes(x) for x in group["counts"]]).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        n = np.add.reduceat(counts, first)
        keep = n >= settings.min_count
        keys, n = keys[first][keep], n[keep]
        if not len(keys):
            return pd.DataFrame({"file": []})
        context, word = _parted(keys, width)
        begins = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
        sizes = np.diff(np.append(begins, len(keys)))
        # Each context's words go on from the last value of the context before.
        lasts = np.cumsum(word[np.append(begins[1:], len(keys)) - 1])
        child = word + np.repeat(np.concatenate([[0], lasts[:-1]]), sizes)
        context, total = context[begins], totals(context[begins])
        kept = np.add.reduceat(n - discount, begins)
        # Contexts without children have weight 1 and point to nothing.
        weight = np.zeros(int(context[-1] - context[0]) + 1, dtype=np.uint16)
        weight[context - context[0]] = _backoff(kept, total)
        held = np.zeros(len(weight) + 1, dtype=np.int64)
        held[context - context[0] + 1] = sizes
        parts = {
            "weight": weight,
            "pointer": EliasFano.build(np.cumsum(held).astype(np.uint64)),
            "child": EliasFano.build(child.astype(np.uint64)),
            "share": _quantise(np.log10((n - discount) / np.repeat(total, sizes))),
        }
        if not pairs and settings.order > 2:  # what the triples after a pair are shares of
            parts["count"] = n.astype(np.uint32 if n.max() < 1 << 32 else np.uint64)
        # The first and the last context may go on in other files.
        edges = [(int(context[k]), float(kept[k]), int(total[k])) for k in {0, len(context) - 1}]
        meta = {"first": int(keys[0]), "first_context": int(context[0]), "n": len(keys), "edges": edges}
        return pd.DataFrame({"file": [pack(meta, parts)]})

    packed = texts.mapInArrow(blocks, "shard int, keys binary, counts binary")
    return packed.groupBy("shard").applyInPandas(file, "file binary")


def _pack_planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte, all first bytes first: the planes of small numbers are zeros, which Spark compresses."""
    width = max(1, -(-int(values.max()).bit_length() // 8))
    size = values.dtype.itemsize
    return bytes([width]) + values.view(np.uint8).reshape(-1, size)[:, :width].T.tobytes()


def _unpack_planes(raw: bytes) -> np.ndarray:
    width = raw[0]
    planes = np.frombuffer(raw, dtype=np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, :width] = planes.T
    return out.reshape(-1).view(np.uint64)


def _pack_ascending(keys: np.ndarray) -> bytes:
    return _pack_planes(np.diff(keys, prepend=0).astype(np.uint64))


def _unpack_ascending(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpack_planes(raw).astype(np.int64))


def held_out(id_column: Column, folds: int = 10, fold: int = 0) -> Column:
    """Whether a row is kept from training, by the CRC-32 of its id as text (a null id: of the empty text)."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % folds == fold


def with_scores(docs: DataFrame, model: Model) -> DataFrame:
    """``id`` and ``text`` scored whole: ``id``, ``n_tokens``, ``n_known``, ``base_score``, ``score``. Row-local; tasks map
    the model's files and hold one slice of a batch. A null or empty text is one end."""
    levels = (model.words, model.levels, model.ends, model.settings)
    kind = docs.schema["id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _trie(*levels)
        for batch in batches:
            done = 0
            for part in _chunks(batch.column("text")):
                found = {"id": batch.column("id").slice(done, len(part)), **trie.score(part)}
                done += len(part)
                yield pa.RecordBatch.from_pydict(found)

    return docs.select("id", "text").mapInArrow(
        score, f"id {kind}, n_tokens long, n_known long, base_score double, score double"
    )


def score_report(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """One row per row of ``docs``, scored by a model of the rows outside the held-out fold: id, ``held_out`` and what
    ``with_scores`` gives, and ``train_tokens``. Repeated rows are trained on and scored each; other columns play no
    part; no rows give no rows."""
    only = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    model = train(only.where(~held_out(F.col("id"))).select("text"), settings)
    return with_scores(only, model).select(
        F.col("id").alias(id_col),
        held_out(F.col("id")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
