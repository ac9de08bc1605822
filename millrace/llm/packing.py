"""Packing of token rows into sequences of one length.

A document's ids are cut into blocks of the sequence length; a full block is a sequence of its own and never moves. The
last blocks, all shorter, are dealt at random into groups of bounded size, and each group is packed by first-fit decreasing:
the leftmost bin with enough room is found by walking down a tournament tree of the bins' free room. Since documents may be
cut, the emptiest bins are then taken apart to fill up the others, and what is left of the last bin goes into sequences of
powers of two, which need no padding.

Groups see numbers and lengths of blocks, no ids; a block's ids, at most one sequence long, are joined to its places
afterwards. No row is longer than a sequence, however long a document is.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.bytelevel import byte_level_encoder
from millrace.session import written

CAPACITY = 1024
GROUP = 16_384  # blocks of a group, about
ID_BYTES = 4  # ids are stored as little-endian unsigned 32-bit numbers
CHUNK = 1_000_000  # characters encoded at once; one longer text is encoded alone


def token_blocks(docs: DataFrame, path: str, end: int, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """Rows ``id, start, length, doc_tokens, ids`` of at most ``capacity`` ids each: the ids of every text and the id ``end``."""
    only = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_level_encoder(path, specials=True)
        for batch in batches:
            texts, at = batch.column("text").to_pylist(), 0
            while at < len(texts):
                last, size = at, 0
                while last < len(texts) and (last == at or size + len(texts[last]) <= CHUNK):
                    size += len(texts[last])
                    last += 1
                yield blocks(batch.column("id").slice(at, last - at), encode(texts[at:last]))
                at = last

    def blocks(ids: pa.Array, encoded: list[list[int]]) -> pa.RecordBatch:
        tokens = np.array([len(e) + 1 for e in encoded], dtype=np.int64)
        flat = chain.from_iterable(chain(e, (end,)) for e in encoded)
        raw = np.fromiter(flat, dtype="<u4", count=int(tokens.sum())).tobytes()
        many = -(-tokens // capacity)
        doc = np.repeat(np.arange(len(tokens)), many)
        start = (np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)) * capacity
        length = np.minimum(capacity, tokens[doc] - start)
        cuts = np.concatenate([[0], np.cumsum(length) * ID_BYTES]).astype(np.int32)
        binary = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(cuts), pa.py_buffer(raw)])
        columns = [ids.take(pa.array(doc)), *(pa.array(x, pa.int64()) for x in (start, length, tokens[doc])), binary]
        return pa.RecordBatch.from_arrays(columns, names=["id", "start", "length", "doc_tokens", "ids"])

    id_type = only.schema["id"].dataType.simpleString()
    return only.mapInArrow(run, f"id {id_type}, start long, length long, doc_tokens long, ids binary")


def first_fit(lengths: list[int], capacity: int) -> list[int]:
    """The bin of each length: the leftmost one with room. The tree holds at every node the most room below it."""
    leaves = 1 << max(0, len(lengths) - 1).bit_length()
    room, bins = [capacity] * (2 * leaves), []
    for need in lengths:
        node = 1
        while node < leaves:
            node *= 2
            node += room[node] < need
        bins.append(node - leaves)
        room[node] -= need
        while node > 1:
            node //= 2
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
    return bins


def fill_up(bins: list[list[tuple[int, int, int]]], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Bins of pieces (block, start, length) without padding: the emptiest bins are cut up to fill the fullest ones, and the
    last open bin becomes sequences of powers of two."""
    fill = lambda pieces: sum(length for *_, length in pieces)
    bins = sorted(bins, key=fill, reverse=True)
    to, donor = 0, len(bins) - 1
    gap = capacity - fill(bins[0]) if bins else 0
    while to < donor:
        if not gap:
            to += 1
            gap = capacity - fill(bins[to])
        elif not bins[donor]:
            bins.pop()
            donor -= 1
        else:
            block, start, length = bins[donor].pop()
            taken = min(gap, length)
            bins[to].append((block, start, taken))
            gap -= taken
            if taken < length:
                bins[donor].append((block, start + taken, length - taken))
    while bins and not bins[-1]:
        bins.pop()
    rest = bins.pop() if bins else []
    left = fill(rest)
    for power in (1 << k for k in range(left.bit_length() - 1, -1, -1)):
        if left & power:
            sequence, gap = [], power
            while gap:
                block, start, length = rest.pop(0)
                taken = min(gap, length)
                sequence.append((block, start, taken))
                gap -= taken
                if taken < length:
                    rest.insert(0, (block, start + taken, length - taken))
            bins.append(sequence)
    return bins


def pack_group(blocks: np.ndarray, lengths: np.ndarray, capacity: int) -> pd.DataFrame:
    """Places of the blocks of one group: ``block, cut, length, bin, offset``. Equal lengths are taken by block number."""
    order = np.lexsort((blocks, -lengths))
    blocks, lengths = blocks[order].tolist(), lengths[order].tolist()
    bins: list[list[tuple[int, int, int]]] = []
    for block, length, at in zip(blocks, lengths, first_fit(lengths, capacity)):
        if at == len(bins):
            bins.append([])
        bins[at].append((block, 0, length))
    places = []
    for at, pieces in enumerate(fill_up(bins, capacity)):
        offset = 0
        for block, cut, length in pieces:
            places.append((block, cut, length, at, offset))
            offset += length
    return pd.DataFrame(places, columns=["block", "cut", "length", "bin", "offset"], dtype="int64")


def _part(ids: Column, start: Column, length: Column) -> Column:
    return F.substring(ids, (start * ID_BYTES + 1).cast("int"), (length * ID_BYTES).cast("int"))


def packed_pieces(
    docs: DataFrame,
    path: str,
    end: int = 0,
    capacity: int = CAPACITY,
    group: int = GROUP,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: the id, ``start`` (ids of its row of ``docs`` before it), ``length``, ``doc_tokens`` (all ids of the
    row, ``end`` included), ``ids`` (the piece itself, little-endian unsigned 32-bit numbers), ``sequence_id`` and ``offset``.

    The pieces of a sequence lie side by side from 0 and have ``capacity`` ids together, or a smaller power of two: at most
    one sequence of each smaller power in a group. A null text counts as empty and has the id ``end`` alone. Repeated rows
    and null ids are packed each for themselves; other columns play no part; no rows give no rows. ``capacity`` is a power
    of two. Groups hold about ``group`` blocks, dealt by a hash of their numbers, so no key or long text makes one large.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError(f"the capacity must be a power of two, not {capacity}")
    blocks = token_blocks(docs, path, end, capacity, id_col, text_col)
    blocks = written(blocks.withColumn("block", F.monotonically_increasing_id()), "token-blocks")
    short = blocks.where(F.col("length") < capacity)
    groups = max(1, -(-short.count() // group))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        places = pack_group(rows["block"].to_numpy(), rows["length"].to_numpy(), capacity)
        return places.assign(group=rows["group"].iloc[0])

    dealt = short.select("block", "length", F.pmod(F.xxhash64("block"), F.lit(groups)).alias("group"))
    places = dealt.groupBy("group").applyInPandas(pack, "block long, cut long, length long, bin long, offset long, group long")
    places = places.select(
        F.col("block").alias("of"),
        "cut",
        F.col("length").alias("taken"),
        # Full blocks have the even numbers.
        (2 * (F.col("group") * 2**32 + F.col("bin")) + 1).alias("sequence_id"),
        "offset",
    )
    cut = short.join(places, F.col("block") == F.col("of")).select(
        "id",
        (F.col("start") + F.col("cut")).alias("start"),
        F.col("taken").alias("length"),
        "doc_tokens",
        _part(F.col("ids"), F.col("cut"), F.col("taken")).alias("ids"),
        "sequence_id",
        "offset",
    )
    full = blocks.where(F.col("length") == capacity).select(
        "id", "start", "length", "doc_tokens", "ids", (2 * F.col("block")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return full.unionAll(cut).withColumnRenamed("id", id_col)


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence of ``packed_pieces``: ``sequence_id``, ``length`` and its ``ids``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
