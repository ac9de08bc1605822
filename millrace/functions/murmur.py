"""MURMUR64: the first 64 bits of MurmurHash3 x64 128 (seed 0) over UTF-8, signed.

Spark's own hash is 32-bit and xxhash64 differs, so this is an Arrow function. It works on the string column's
buffers with NumPy, all rows of a batch at once: one pass per 16-byte block position, rows sorted longest first, so
each pass touches only the rows that are still that long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

# The constants of the published algorithm.
_C1 = np.uint64(0x87C37B91114253D5)
_C2 = np.uint64(0x4CF5AD432745937F)
_MIX1 = np.uint64(0xFF51AFD7ED558CCD)
_MIX2 = np.uint64(0xC4CEB9FE1A85EC53)
_ADD1 = np.uint64(0x52DCE729)
_ADD2 = np.uint64(0x38495AB5)


def _rotl(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _final_mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _MIX1
    x = (x ^ (x >> np.uint64(33))) * _MIX2
    return x ^ (x >> np.uint64(33))


def _scramble1(k: np.ndarray) -> np.ndarray:
    return _rotl(k * _C1, 31) * _C2


def _scramble2(k: np.ndarray) -> np.ndarray:
    return _rotl(k * _C2, 33) * _C1


# With fewer rows than this still going, plain integers beat array operations on them.
_FEW_ROWS = 6
_MASK = (1 << 64) - 1


def _finish_blocks(h1: int, h2: int, words1: list[int], words2: list[int]) -> tuple[int, int]:
    """The block rounds of one row, from its scrambled words."""
    for k1, k2 in zip(words1, words2):
        h1 ^= k1
        h1 = ((((h1 << 27) & _MASK) | (h1 >> 37)) + h2) * 5 + 0x52DCE729 & _MASK
        h2 ^= k2
        h2 = ((((h2 << 31) & _MASK) | (h2 >> 33)) + h1) * 5 + 0x38495AB5 & _MASK
    return h1, h2


def murmur64_bytes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Signed hashes of the byte ranges ``data[start : start + length]``."""
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order].astype(np.int64), lengths[order].astype(np.int64)
    blocks = lengths // 16
    # All whole blocks, row after row, scrambled in one go; only the chaining below is sequential.
    pieces = [data[s : s + 16 * n] for s, n in zip(starts.tolist(), blocks.tolist()) if n]
    words = np.concatenate(pieces).view("<u8") if pieces else np.zeros(0, np.uint64)
    words1, words2 = _scramble1(words[0::2]), _scramble2(words[1::2])
    firsts = np.concatenate([[0], np.cumsum(blocks)[:-1]]) if len(blocks) else blocks
    h1 = np.zeros(len(lengths), np.uint64)
    h2 = np.zeros(len(lengths), np.uint64)
    five, block, most = np.uint64(5), 0, int(blocks[0]) if len(blocks) else 0
    while block < most:
        live = int(np.searchsorted(-blocks, -block, side="left"))  # rows with more blocks than this one
        if live < _FEW_ROWS:
            break
        at = firsts[:live] + block
        a, b = h1[:live], h2[:live]
        a = (_rotl(a ^ words1[at], 27) + b) * five + _ADD1
        b = (_rotl(b ^ words2[at], 31) + a) * five + _ADD2
        h1[:live], h2[:live] = a, b
        block += 1
    for row in range(int(np.searchsorted(-blocks, -block, side="left"))):
        span = slice(int(firsts[row]) + block, int(firsts[row] + blocks[row]))
        h1[row], h2[row] = _finish_blocks(int(h1[row]), int(h2[row]), words1[span].tolist(), words2[span].tolist())
    tail = lengths - 16 * blocks
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    rest = padded[(starts + 16 * blocks)[:, None] + np.arange(16)]
    rest[np.arange(16)[None, :] >= tail[:, None]] = 0
    last = rest.view("<u8")
    # A zero word scrambles to zero, so rows without that part of a tail are unchanged.
    h2 ^= _scramble2(last[:, 1])
    h1 ^= _scramble1(last[:, 0])
    size = lengths.astype(np.uint64)
    h1, h2 = h1 ^ size, h2 ^ size
    h1 = h1 + h2
    h2 = h2 + h1
    h1, h2 = _final_mix(h1), _final_mix(h2)
    out = np.empty(len(lengths), np.uint64)
    out[order] = h1 + h2
    return out.view(np.int64)


@F.arrow_udf(T.LongType())
def _murmur64(text: pa.Array) -> pa.Array:
    filled = text.cast(pa.large_binary())
    _, offsets, data = filled.buffers()
    ends = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    hashes = murmur64_bytes(raw, ends[:-1], np.diff(ends))
    nulls = text.is_null().to_numpy(zero_copy_only=False)
    return pa.array(hashes, type=pa.int64(), mask=nulls)


def murmur64(text: Column) -> Column:
    """MURMUR64 of a text column; NULL gives NULL."""
    return _murmur64(text)


#: The function as registered for SQL.
MURMUR64 = _murmur64
