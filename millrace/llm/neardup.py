"""Near-duplicate documents: improved consistent weighted sampling over TF-IDF weighted shingles, banded, verified by
weighted Jaccard similarity, and closed to classes.

Equal texts are one node of the graph from the start, so a group of exact copies costs one node. In each band bucket the
nodes are compared with one leader, not with each other: the node that meets most others in its buckets, which is the text
that a group was copied from, if it is there. What is linked is contracted to components, and only then are
nodes of different components compared: all of them in buckets of up to ``SMALL_BUCKET`` nodes; larger buckets are cut
by a second band (similar texts share several bands), where leaders link most of them, and then get more leaders in
rounds until no pair of different components is untested. Links, components and signatures are tables; nothing of the
corpus reaches the driver but counts and the fixed-size table of frequencies.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import unused
from millrace.session import written

_WORD = re.compile(r"\w+")
# What the pattern finds in an ASCII text in lower case, as bytes between blanks.
_ASCII_WORDS = bytes(ord(chr(c).lower()) if c < 128 and _WORD.match(chr(c)) else 32 for c in range(256))
_MULTIPLIER = 0x9E3779B97F4A7C15
SMALL_BUCKET = 64
LEADER_GROWTH = 16
MAX_BROADCAST_BYTES = 32 << 20
SKETCH_WORDS = 16  # of 64 cells each


@dataclass(frozen=True)
class Settings:
    """``shingle`` words; similarity from ``threshold`` on; ``bands`` of ``rows`` samples each; document frequencies are
    counted in ``2**df_bits`` hashed cells. ``idf_strength`` is how much heavier a shingle that occurs nowhere else is
    than one that occurs everywhere: with 0.25 weights lie between 1 and 1.25, so that the many members of a large
    group of near copies, whose common shingles are frequent, still count as similar."""

    shingle: int = 5
    threshold: float = 0.8
    bands: int = 14
    rows: int = 4
    df_bits: int = 20
    idf_strength: float = 0.25
    seed: int = 7

    def agreeing(self) -> int:
        """How many samples two texts must share to be compared: of similar ones fewer are equal in about one pair of 5,000."""
        n, t = self.bands * self.rows, self.threshold
        return max(1, int(n * t - 3.5 * (n * t * (1 - t)) ** 0.5))


class Shingler:
    """Texts to distinct shingle hashes, ascending, and how often each occurs."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.powers = [np.uint64(pow(_MULTIPLIER, 2 * j + 1, 1 << 64)) for j in range(size)]

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        h = _hashes(_words(text or ""))
        k = min(self.size, len(h))  # a text of fewer words is one shingle
        if not k:
            return h, np.zeros(0, dtype=np.int64)
        n = len(h) - k + 1
        s = np.full(n, k, dtype=np.uint64)
        for j in range(k):
            s ^= h[j : j + n]
            s *= self.powers[j]
            s ^= s >> np.uint64(29)
        s.sort()
        first = np.flatnonzero(_changes(s))
        return s[first], np.diff(first, append=n)


def _words(text: str) -> list[str] | list[bytes]:
    """The words of a text in lower case; those of an ASCII text as bytes, which costs much less."""
    return text.encode().translate(_ASCII_WORDS).split() if text.isascii() else _WORD.findall(text.lower())


def _hashes(words: list[str] | list[bytes]) -> np.ndarray:
    """64-bit hashes of words. Looking them up in a table of known words would cost more."""
    try:
        return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    except UnicodeEncodeError:
        return _hashes([w.encode("utf-8", "surrogatepass") for w in words])


def _changes(ascending: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before."""
    out = np.ones(len(ascending), dtype=bool)
    np.not_equal(ascending[1:], ascending[:-1], out=out[1:])
    return out


def _cells(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


_BLOCK = 4096
_TASKS_ADDED = 256


def document_frequencies(texts: DataFrame, settings: Settings) -> tuple[np.ndarray, int]:
    """How many texts have a shingle in each hashed cell, over all texts, and the number of texts.

    Each task sends its counters once, whatever it has read; they are added in two steps. The sum has a fixed size."""
    bits, size = settings.df_bits, settings.shingle

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counters, shingler, n = np.zeros(1 << bits, dtype=np.int64), Shingler(size), 0
        for batch in batches:
            for text in batch["text"]:
                cells = _cells(shingler(text)[0], bits)  # ascending, as the hashes are
                counters[cells[_changes(cells)]] += 1
            n += len(batch)
        if n:
            # So many tasks are added in one group, and then the groups: no group has more arrays than either.
            salt = TaskContext.get().partitionId() // _TASKS_ADDED
            blocks = counters.reshape(-1, min(_BLOCK, 1 << bits))
            for start in range(0, len(blocks), 64):
                part = blocks[start : start + 64]
                yield pd.DataFrame(
                    {"block": np.arange(start, start + len(part)), "salt": salt, "n": n, "counts": list(part)}
                )

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(np.stack(group["counts"].to_numpy()), axis=0)
        return pd.DataFrame(
            {"block": [group["block"].iloc[0]], "salt": [0], "n": [group["n"].sum()], "counts": [total]}
        )

    schema = "block long, salt long, n long, counts array<long>"
    parts = texts.select("text").mapInPandas(count, schema)
    summed = parts.groupBy("block", "salt").applyInPandas(add, schema).groupBy("block").applyInPandas(add, schema)
    frequencies, n = np.zeros(1 << bits, dtype=np.float32), 0
    for row in summed.toLocalIterator():  # 2**df_bits counters in all
        width = len(row["counts"])
        frequencies[row["block"] * width : (row["block"] + 1) * width] = row["counts"]
        n = max(n, row["n"])
    return frequencies, n


def idf_table(frequencies: np.ndarray, n: int, strength: float) -> np.ndarray:
    """1 for a cell in every text, up to ``1 + strength`` for one in none."""
    rare = np.log((n + 1.0) / (np.minimum(frequencies, n) + 1.0)) / np.log(n + 2.0)
    return (1.0 + strength * rare).astype(np.float32)


class Sampler:
    """Consistent weighted samples: the same (shingle, level) is drawn from two weighted sets with the probability of
    their weighted Jaccard similarity. The random variates of a shingle come from tables that its hash points into."""

    _TABLE, _CHUNK = 1 << 16, 1024

    def __init__(self, settings: Settings) -> None:
        rng = np.random.default_rng(settings.seed)
        self.bands, self.rows, k = settings.bands, settings.rows, settings.bands * settings.rows
        self.r = rng.gamma(2.0, 1.0, self._TABLE).astype(np.float32)
        self.log_c = np.log(rng.gamma(2.0, 1.0, self._TABLE)).astype(np.float32)
        self.beta = rng.random(self._TABLE).astype(np.float32)
        self.odd = rng.integers(1, 1 << 63, k, dtype=np.uint64) | np.uint64(1)
        self.mix = rng.integers(1, 1 << 63, k, dtype=np.uint64) | np.uint64(1)

    def samples(self, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        best, found = np.full(len(self.odd), np.inf, dtype=np.float32), np.zeros(len(self.odd), dtype=np.uint64)
        samples = np.arange(len(self.odd))
        for start in range(0, len(hashes), self._CHUNK):  # a long text needs no more memory than a chunk
            h, w = hashes[start : start + self._CHUNK], weights[start : start + self._CHUNK]
            at = self.odd[:, None] * h  # a row for each sample
            at >>= np.uint64(48)
            at = at.view(np.int64)
            r, beta = self.r.take(at, mode="clip"), self.beta.take(at, mode="clip")
            level = np.log(w, dtype=np.float32) / r
            level += beta
            np.floor(level, out=level)
            rank = np.subtract(level, beta, out=beta)
            rank *= r
            np.subtract(self.log_c.take(at, mode="clip"), rank, out=rank)
            rank -= r
            first = rank.argmin(axis=1)
            value = h[first] * self.mix ^ level[samples, first].astype(np.int64).astype(np.uint64)
            least = rank[samples, first]
            better = least < best
            best, found = np.where(better, least, best), np.where(better, value, found)
        return found

    def signature(self, hashes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The keys of the bands, and 16 bits of each sample."""
        samples = self.samples(hashes, weights)
        prints = (samples * np.uint64(_MULTIPLIER)) >> np.uint64(48)
        return self._keys(samples), prints.astype(np.uint16).view(np.int16)

    def keys(self, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """One key for each band: equal keys mean equal samples in the whole band."""
        return self._keys(self.samples(hashes, weights))

    def _keys(self, samples: np.ndarray) -> np.ndarray:
        parts = samples.reshape(self.bands, self.rows)
        key = np.arange(1, self.bands + 1, dtype=np.uint64)
        for j in range(self.rows):
            key = (key ^ parts[:, j]) * np.uint64(_MULTIPLIER)
            key ^= key >> np.uint64(31)
        return key.view(np.int64)


def _weigh(hashes: np.ndarray, counts: np.ndarray, idf: np.ndarray, bits: int) -> np.ndarray:
    return (1.0 + np.log(counts)) * idf[_cells(hashes, bits)]


def text_node(text: Column) -> Column:
    """What stands for a text: its MD5 as 16 bytes, null for a null or empty text."""
    return F.when(F.length(text) > 0, F.unhex(F.md5(text.cast("binary"))))


def _signatures(texts: DataFrame, idf: Broadcast, settings: Settings) -> DataFrame:
    """``node``, ``keys``, ``prints`` and the ``total`` weight of each text (``node``, ``text``); texts without words have no
    keys."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, sampler, table = Shingler(settings.shingle), Sampler(settings), idf.value
        for batch in batches:
            found = []
            for text in batch["text"]:
                hashes, counts = shingler(text)
                weights = _weigh(hashes, counts, table, settings.df_bits)
                signature = sampler.signature(hashes, weights) if len(hashes) else nothing
                found.append((*signature, float(weights.sum(dtype=np.float64))))
            keys, prints, total = zip(*found) if found else ((), (), ())
            yield pd.DataFrame(
                {"id": batch["id"], "node": batch["node"], "keys": keys, "prints": prints, "total": np.array(total, dtype=float)}
            )

    nothing = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int16)
    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInPandas(sign, f"id {kind}, node binary, keys array<long>, prints array<short>, total double")


def _weighted(texts: DataFrame, idf: Broadcast, settings: Settings) -> DataFrame:
    """``node``, ``hashes``, ``weights`` and the ``sketch`` of each text (``node``, ``text``)."""

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, table = Shingler(settings.shingle), idf.value
        for batch in batches:
            sets = [shingler(text) for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "node": batch["node"],
                    "hashes": [h.view(np.int64) for h, _ in sets],
                    "weights": [_weigh(h, c, table, settings.df_bits).astype(np.float32) for h, c in sets],
                    "sketch": [sketch(h) for h, _ in sets],
                }
            )

    return texts.mapInPandas(weigh, "node binary, hashes array<long>, weights array<float>, sketch array<long>")


def sketch(hashes: np.ndarray) -> np.ndarray:
    """One bit for each cell of hashes that a text has. A cell that only one of two texts has holds a shingle that the other
    one lacks, and no shingle weighs less than one."""
    cells = np.zeros(SKETCH_WORDS * 64, dtype=np.uint8)
    cells[(hashes % np.uint64(len(cells))).astype(np.int64)] = 1
    return np.packbits(cells, bitorder="little").view(np.int64)


def weighted_jaccard(h1: np.ndarray, w1: np.ndarray, h2: np.ndarray, w2: np.ndarray) -> float:
    """Sum of smaller weights by sum of larger ones, over all shingles of two texts."""
    _, i, j = np.intersect1d(h1, h2, assume_unique=True, return_indices=True)
    common = np.minimum(w1[i], w2[j]).sum(dtype=np.float64)
    whole = w1.sum(dtype=np.float64) + w2.sum(dtype=np.float64) - common
    return common / whole if whole else 0.0


def _similar(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (``a``, ``b``) whose texts are similar. Spark splits the partitions of leaders with many members."""

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = [
                weighted_jaccard(*map(np.asarray, row)) >= threshold
                for row in zip(batch["h1"], batch["w1"], batch["h2"], batch["w2"])
            ]
            yield batch.loc[keep, ["a", "b"]]

    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("h1"), F.col("weights").alias("w1"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("h2"), F.col("weights").alias("w2"))
    return pairs.join(right, "b").join(left, "a").mapInPandas(judge, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node it is linked to, of every node of ``edges`` (``a``, ``b``).

    Labels spread along edges and then jump to the label of their label, so chains shorten by half at least each time;
    every step is a written table."""
    both = written(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "labels")
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        closer = seen.join(labels, "node").select("node", F.col("label").alias("old"), F.least("near", "label").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = closer.join(jump, "label").select("node", "old", F.least("label", "further").alias("label"))
        labels = written(moved, "labels")
        if not labels.where("label <> old").limit(1).count():
            return labels.select("node", "label")
        labels = labels.select("node", "label")


def _merged(labels: DataFrame, found: DataFrame) -> DataFrame:
    """``labels`` after the links ``found`` (``a``, ``b``) between its components and nodes without a label.

    Components are contracted to their labels, so the work grows with the new links; the old ones are not followed again."""
    first = found.join(labels.select(F.col("node").alias("a"), F.col("label").alias("from")), "a", "left")
    ends = first.join(labels.select(F.col("node").alias("b"), F.col("label").alias("to")), "b", "left").select(
        F.coalesce("from", "a").alias("a"), F.coalesce("to", "b").alias("b")
    )
    moved = components(written(ends.where("a <> b").distinct(), "contracted"))
    after = labels.join(moved.select(F.col("node").alias("label"), F.col("label").alias("new")), "label", "left")
    fresh = moved.join(labels.select("node"), "node", "left_anti")
    return written(after.select("node", F.coalesce("new", "label").alias("label")).unionByName(fresh), "merged")


def _company(buckets: DataFrame) -> DataFrame:
    """``buckets`` with ``company``: how many nodes a node meets in all its buckets. The text that others were copied from
    shares more samples with each copy than the copies share among themselves, so it has the most."""
    sizes = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    met = buckets.join(sizes, "key").groupBy("node").agg(F.sum("n").alias("company"))
    return buckets.join(met, "node")


def _leader_pairs(buckets: DataFrame) -> DataFrame:
    """(leader, member) of each bucket (``key``, ``node``, ``company``), the leader being the node with the most company, the
    greater one of equals."""
    first = F.max(F.struct("company", "node"))
    leaders = buckets.groupBy("key").agg(first.alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    leaders = written(leaders.select("key", F.col("first.node").alias("a")), "leaders")
    return buckets.join(leaders, "key").where("node <> a").select("a", F.col("node").alias("b")).distinct()


def _may_be_similar(settings: Settings) -> Column:
    """A condition of joins, so that no other pair is made: the lighter text weighs at least ``threshold`` of the other one
    and their sketches differ in no more cells than their weights leave room for, as it always is with similar texts, and
    enough samples are equal."""
    lighter, heavier = F.least("total", "other_total"), F.greatest("total", "other_total")
    equal = F.zip_with("prints", "other_prints", lambda a, b: (a == b).cast("int"))
    agree = F.aggregate(equal, F.lit(0), lambda n, x: n + x) >= settings.agreeing()
    differ = reduce(
        Column.__add__, (F.bit_count(F.get("sketch", F.lit(i)).bitwiseXOR(F.get("other_sketch", F.lit(i)))) for i in range(SKETCH_WORDS))
    )
    # The differences of all weights add up to (1 - t) / (1 + t) of both texts' weights at similarity t.
    room = differ * (1 + settings.threshold) <= (lighter + heavier) * (1 - settings.threshold + 1e-5)
    return (lighter >= heavier * (settings.threshold - 1e-5)) & F.when(room, agree).otherwise(False)


def _mixed(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """The members (``key``, ``node``, ``label``) of buckets with more than one component, and how many the bucket has (``n``)."""
    named = buckets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = named.groupBy("key").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n")
    )
    mixed = written(mixed.where("low <> high").select("key", "n"), "mixed")
    return written(named.join(mixed, "key"), "mixed-members")


def _with_nodes(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """``members`` with all their buckets (``keys``) and what tells whether they may be similar."""
    own = members.groupBy("node").agg(F.collect_list("key").alias("keys"))
    return members.join(own, "node").join(nodes.select("node", "prints", "total", "sketch"), "node")


def _cross_pairs(small: DataFrame, tested: DataFrame, nodes: DataFrame, settings: Settings) -> DataFrame:
    """Untested pairs of different components in the buckets ``small`` (``key``, ``node``, ``label``)."""
    # Two nodes that share several of these buckets meet in the first one only.
    small = written(_with_nodes(small, nodes), "small-buckets")
    other = small.select(
        "key",
        F.col("node").alias("other"),
        F.col("label").alias("other_label"),
        F.col("keys").alias("other_keys"),
        F.col("prints").alias("other_prints"),
        F.col("total").alias("other_total"),
        F.col("sketch").alias("other_sketch"),
    )
    once = F.col("key") == F.array_min(F.array_intersect("keys", "other_keys"))
    differ = (F.col("node") < F.col("other")) & (F.col("label") != F.col("other_label"))
    met = small.join(other, "key").where(differ & _may_be_similar(settings) & once)
    pairs = met.select(F.col("node").alias("a"), F.col("other").alias("b"))
    return pairs.join(tested, ["a", "b"], "left_anti")


def _mixed_members(large: DataFrame, labels: DataFrame) -> DataFrame:
    """Those members of large buckets whose bucket has more than one component, with the label of the largest component of
    the bucket (``big``), how many nodes are in it (``inside``) and in other ones (``others``)."""
    named = large.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    sizes = named.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    per_key = sizes.groupBy("key").agg(
        F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts")
    )
    per_key = per_key.where("parts > 1").select(
        "key", F.col("top.label").alias("big"), F.col("top.n").alias("inside"), (F.col("n") - F.col("top.n")).alias("others")
    )
    return written(named.join(written(per_key, "round-keys"), "key"), "round-members")


def _round_pairs(mixed: DataFrame, leaders: int, settings: Settings) -> DataFrame:
    """Pairs of different components, one of them a leader: in each bucket about ``leaders`` nodes of its largest component
    and as many of the others. When there are no more others than that, all of them lead and no pair is left."""
    draw = F.pmod(F.xxhash64(F.lit("leader"), "node"), F.lit(1 << 30)) / float(1 << 30)
    outside = F.col("label") != F.col("big")
    leads = F.when(outside, draw * F.col("others") < leaders).otherwise(
        (F.col("others") > leaders) & (draw * F.col("inside") < leaders)
    )
    first = mixed.where(leads).select("key", "node", "label", "keys", "prints", "total", "sketch")
    second = mixed.select(
        "key",
        F.col("node").alias("other"),
        F.col("label").alias("other_label"),
        F.col("keys").alias("other_keys"),
        F.col("prints").alias("other_prints"),
        F.col("total").alias("other_total"),
        F.col("sketch").alias("other_sketch"),
    )
    # Two nodes that share several large buckets meet in the first one only; all that nodes of two components share are mixed.
    once = F.col("key") == F.array_min(F.array_intersect("keys", "other_keys"))
    met = first.join(second, "key").where((F.col("label") != F.col("other_label")) & _may_be_similar(settings) & once)
    return met.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``node`` and ``class_id``, the smallest id of its class.

    Equal texts are of one class, and so are texts of similarity ``threshold`` or more and what they are linked to. Null
    and empty texts are a class each of their own (``node`` is null, ``class_id`` the own id); texts without words are
    linked to equal ones only. Repeated rows are copies; null ids are never the smallest. No rows give no rows. Texts of
    any length are read whole. Sampling misses a link at similarity 0.8 with a probability of about 0.0006, far less
    above.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    frequencies, n = document_frequencies(texts, settings)
    idf = spark.sparkContext.broadcast(idf_table(frequencies, n, settings.idf_strength))
    rows = written(_signatures(texts.withColumn("node", text_node(F.col("text"))), idf, settings), "signatures")
    nodes = rows.where("node IS NOT NULL AND size(keys) > 0").groupBy("node").agg(
        F.first("keys").alias("keys"), F.first("prints").alias("prints"), F.first("total").alias("total"), F.min("id").alias("id")
    )
    nodes = written(nodes, "nodes")
    labels = _classes(texts, nodes, idf, settings)
    named = rows.join(labels, "node", "left").select("id", "node", F.coalesce("label", "node").alias("label"))
    named = written(named, "named")
    first = written(named.where("label IS NOT NULL").groupBy("label").agg(F.min("id").alias("class_id")), "class-ids")
    return named.join(first, "label", "left").select(
        "id", "node", F.when(F.col("label").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id")
    )


def _classes(texts: DataFrame, nodes: DataFrame, idf: Broadcast, settings: Settings) -> DataFrame:
    """``node`` and ``label`` of all nodes that are linked to another one."""
    buckets = nodes.select("node", F.explode("keys").alias("key"))
    shared = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    # Most keys occur once; what follows needs only the buckets that two nodes share.
    buckets = written(_company(written(buckets.join(written(shared, "shared-keys"), "key"), "shared-buckets")), "buckets")
    sets = _sets_of(buckets.select("node").distinct(), texts, nodes, idf, settings)
    nodes = written(nodes.join(sets.select("node", "sketch"), "node"), "sketched-nodes")

    pairs = written(_leader_pairs(buckets), "pairs")
    labels = components(written(_similar(pairs, sets, settings.threshold), "similar"))

    in_large = F.col("n") > SMALL_BUCKET
    rest = _mixed(buckets.select("key", "node"), labels)
    large = written(rest.where(in_large).select("key", "node"), "large-buckets")
    if large.limit(1).count():
        members = large.join(nodes.select("node", F.explode("keys").alias("other")), "node").where("key <> other")
        members = members.join(buckets.select("node", "company").distinct(), "node")
        half = F.xxhash64(F.least("key", "other"), F.greatest("key", "other")).alias("key")
        halves = members.select(half, "node", "company").distinct()
        halves = written(halves, "half-buckets")
        # Nodes that share two bands are the likeliest to be similar: what their leaders link needs no pairs among itself.
        led = written(_leader_pairs(halves).join(pairs, ["a", "b"], "left_anti"), "half-pairs")
        found = written(_similar(led, sets, settings.threshold), "half-similar")
        labels, pairs = _merged(labels, found), pairs.unionByName(led)
        rest = _mixed(buckets.select("key", "node"), labels)
    small = rest.where(~in_large).select("key", "node", "label")
    more = written(_cross_pairs(small, pairs, nodes, settings), "more-pairs")
    if more.limit(1).count():
        found = written(_similar(more, sets, settings.threshold), "more-similar")
        pairs = pairs.unionByName(more)
        if found.limit(1).count():
            labels = _merged(labels, found)
    if not large.limit(1).count():
        return labels
    large, leaders = written(_with_nodes(large, nodes), "large-members"), 1
    while True:
        mixed = _mixed_members(large, labels)
        if not mixed.limit(1).count():
            return labels
        last = not mixed.where(F.col("others") > leaders).limit(1).count()
        led = written(_round_pairs(mixed, leaders, settings).join(pairs, ["a", "b"], "left_anti"), "round-pairs")
        found = written(_similar(led, sets, settings.threshold), "round-similar")
        pairs = pairs.unionByName(led)
        if found.limit(1).count():
            labels = _merged(labels, found)
        if last:  # each node outside the largest component of its bucket has led
            return labels
        leaders *= LEADER_GROWTH


def _bytes(rows: DataFrame) -> int:
    """About what ``rows`` take in memory: their values as text, and some bytes for each row."""
    size = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in rows.columns), F.lit(40))
    return rows.agg(F.sum(size.cast("long"))).first()[0] or 0


def _sets_of(
    wanted: DataFrame, texts: DataFrame, nodes: DataFrame, idf: Broadcast, settings: Settings
) -> DataFrame:
    """The weighted shingles of the nodes that share a bucket. Their ids are broadcast to the texts while they are below
    ``MAX_BROADCAST_BYTES``, else joined by a shuffle."""
    need = written(nodes.join(wanted, "node").select("node", F.col("id").alias("of")), "needed-nodes")
    small = _bytes(need) <= MAX_BROADCAST_BYTES
    own = texts.withColumn("own", text_node(F.col("text")))
    picked = own.join(F.broadcast(need) if small else need, F.col("id").eqNullSafe(F.col("of")) & (F.col("own") == F.col("node")))
    # An id that is repeated with the same text gives the same set again.
    return written(_weighted(picked.select("node", "text"), idf, settings).dropDuplicates(["node"]), "shingle-sets")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row of each class, the one with the smallest id, with its own columns.

    A class without any id keeps one of its rows. Of rows that repeat both id and text one stays.
    """
    of, own, key = (unused(docs, n) for n in ("kept_id", "kept_node", "own_node"))
    found = written(near_duplicates(docs, id_col, text_col, settings), "classes")
    groups = found.where("node IS NOT NULL").groupBy("id", "node", "class_id").agg(F.count(F.lit(1)).alias("n"))
    # Several texts may share the smallest id of a class: the smallest node decides.
    firsts = groups.where("id <=> class_id").groupBy("class_id", "id").agg(F.min("node").alias("first"))
    judged = groups.join(firsts.select(F.col("class_id").alias("c"), "first"), F.col("class_id").eqNullSafe(F.col("c")), "left")
    out = judged.withColumn("stays", F.col("id").eqNullSafe(F.col("class_id")) & F.col("node").eqNullSafe(F.col("first")))
    odd = written(out.where("NOT stays OR n > 1").select(F.col("id").alias(of), F.col("node").alias(own), "stays"), "not-kept")
    if _bytes(odd) <= MAX_BROADCAST_BYTES:
        odd = F.broadcast(odd)
    same = F.col(f"`{id_col}`").eqNullSafe(F.col(of)) & (F.col(key) == F.col(own))
    keyed = docs.withColumn(key, text_node(F.col(f"`{text_col}`").cast("string")))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    plain = keyed.join(odd, same, "left_anti").select(*columns)
    repeated = keyed.join(odd.where("stays"), same).dropDuplicates([id_col, key]).select(*columns)
    return plain.unionByName(repeated)
