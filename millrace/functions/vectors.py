"""Vector functions: sparse to dense, packing to bytes, distances, exact top-k."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from millrace.options import single_choice
from millrace.session import written

# Fixed value: the largest index a sparse vector may have.
MAX_SPARSE_INDEX = 1_000_000


def sparse_to_dense(sparse: Column) -> Column:
    """``map<int, float>`` to a dense array of length max index + 1, zeros elsewhere; an empty map is empty."""
    keys = F.map_keys(sparse)
    bad = F.exists(keys, lambda k: (k < 0) | (k > MAX_SPARSE_INDEX))
    dense = F.transform(
        F.sequence(F.lit(0), F.array_max(keys)),
        lambda i: F.coalesce(F.try_element_at(sparse, i), F.lit(0.0)).cast("float"),
    )
    return (
        F.when(F.size(keys) == 0, F.array().cast("array<float>"))
        .when(bad, F.raise_error(F.lit(f"sparse vector index outside 0..{MAX_SPARSE_INDEX}")))
        .otherwise(dense)
    )


# Element formats of packed vectors, all big-endian.
PACK_FORMATS = {
    "float": ">f4",
    "double": ">f8",
    "int": ">i4",
    "short": ">i2",
}
_ARROW = {"float": pa.float32(), "double": pa.float64(), "int": pa.int32(), "short": pa.int16()}
_SPARK = {"float": T.FloatType(), "double": T.DoubleType(), "int": T.IntegerType(), "short": T.ShortType()}


def pack_vector(vector: Column, element: str = "float") -> Column:
    """Array to bytes, big-endian. Works on the batch's flat value buffer; there is no per-row Python."""
    fmt, kind = np.dtype(PACK_FORMATS[element]), _ARROW[element]

    @F.arrow_udf(T.BinaryType())
    def pack(column: pa.Array) -> pa.Array:
        sizes = np.asarray(column.value_lengths().fill_null(0))
        values = column.flatten().cast(kind)
        if values.null_count:
            raise ValueError("a packed vector cannot hold NULL elements")
        data = values.to_numpy(zero_copy_only=False).astype(fmt).tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)]) * fmt.itemsize
        packed = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(column), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)]
        )
        return pc.if_else(column.is_valid(), packed, pa.scalar(None, pa.large_binary())).cast(pa.binary())

    return pack(vector)


def unpack_vector(packed: Column, element: str = "float") -> Column:
    """Bytes to array, the inverse of :func:`pack_vector`."""
    fmt, kind = np.dtype(PACK_FORMATS[element]), _ARROW[element]

    @F.arrow_udf(T.ArrayType(_SPARK[element]))
    def unpack(column: pa.Array) -> pa.Array:
        sizes = np.asarray(pc.binary_length(column).fill_null(0)).astype(np.int64)
        if (sizes % fmt.itemsize).any():
            raise ValueError(f"packed length is not a multiple of {fmt.itemsize}")
        raw = b"".join(value for value in column.to_pylist() if value is not None)
        values = np.frombuffer(raw, fmt).astype(fmt.newbyteorder("="))
        ends = np.concatenate([[0], np.cumsum(sizes)]) // fmt.itemsize
        lists = pa.ListArray.from_arrays(
            pa.array(ends.astype(np.int32)),
            pa.array(values, kind),
            mask=column.is_null(),
        )
        return lists

    return unpack(packed)


def _fold(pairs: Column) -> Column:
    return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x)


def inner_product(a: Column, b: Column) -> Column:
    return _fold(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def l2_distance(a: Column, b: Column) -> Column:
    def square(x: Column, y: Column) -> Column:
        gap = x.cast("double") - y.cast("double")
        return gap * gap

    return F.sqrt(_fold(F.zip_with(a, b, square)))


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine similarity; NULL when a vector has no length."""
    norms = F.sqrt(inner_product(a, a)) * F.sqrt(inner_product(b, b))
    return F.when(norms > 0, F.lit(1.0) - inner_product(a, b) / norms)


def _bytes_of(a: pa.Array, b: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of both columns, end to end, where neither is NULL; the row of each byte; which rows count."""
    valid = pc.and_(a.is_valid(), b.is_valid()).to_numpy(zero_copy_only=False)
    a, b = a.filter(pa.array(valid)), b.filter(pa.array(valid))
    sizes = np.asarray(pc.binary_length(a)).astype(np.int64)
    if (sizes != np.asarray(pc.binary_length(b))).any():
        raise ValueError("bit vectors of different lengths have no distance")
    flat = [np.frombuffer(b"".join(column.to_pylist()), np.uint8) for column in (a, b)]
    return flat[0], flat[1], np.repeat(np.arange(len(sizes)), sizes), valid


def _set_bits(flat: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(row, weights=np.bitwise_count(flat), minlength=rows).astype(np.int64)


def _spread(values: np.ndarray, valid: np.ndarray, kind: pa.DataType) -> pa.Array:
    out = np.zeros(len(valid), values.dtype)
    out[valid] = values
    return pa.array(out, kind, mask=~valid)


@F.arrow_udf(T.IntegerType())
def _hamming(a: pa.Array, b: pa.Array) -> pa.Array:
    x, y, row, valid = _bytes_of(a, b)
    return _spread(_set_bits(x ^ y, row, int(valid.sum())).astype(np.int32), valid, pa.int32())


@F.arrow_udf(T.DoubleType())
def _jaccard(a: pa.Array, b: pa.Array) -> pa.Array:
    x, y, row, valid = _bytes_of(a, b)
    shared, either = (_set_bits(bits, row, int(valid.sum())) for bits in (x & y, x | y))
    distance = np.where(either > 0, 1.0 - shared / np.maximum(either, 1), 0.0)
    return _spread(distance, valid, pa.float64())


def hamming_distance(a: Column, b: Column) -> Column:
    """Differing bits of two packed bit vectors of one length."""
    return _hamming(a, b)


def jaccard_distance(a: Column, b: Column) -> Column:
    """1 - shared set bits over all set bits; two empty vectors are equal."""
    return _jaccard(a, b)


@F.arrow_udf(T.BinaryType())
def _pack_bits(flags: pa.Array) -> pa.Array:
    sizes = np.asarray(flags.value_lengths().fill_null(0))
    bits = flags.flatten().to_numpy(zero_copy_only=False).astype(bool)
    # Every row starts at a byte of its own.
    bytes_needed = -(-sizes // 8)
    starts = np.concatenate([[0], np.cumsum(bytes_needed)]).astype(np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(bits)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    wide = np.zeros(int(starts[-1]) * 8, bool)
    wide[starts[row] * 8 + place] = bits
    packed = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(sizes), [None, pa.py_buffer(starts), pa.py_buffer(np.packbits(wide).tobytes())]
    )
    return pc.if_else(flags.is_valid(), packed, pa.scalar(None, pa.large_binary())).cast(pa.binary())


def pack_bits(flags: Column) -> Column:
    """``array<boolean>`` to packed bits, first element in the highest bit."""
    return _pack_bits(flags)


DISTANCES = {"L2": l2_distance, "IP": inner_product, "COSINE": cosine_distance}


def _scores(queries: np.ndarray, block: np.ndarray, metric: str, k: int) -> np.ndarray:
    """Smaller is nearer for every metric; a vector without length has no cosine distance (NaN)."""
    if metric == "L2":
        return _l2_scores(queries, block, k)
    dots = queries @ block.T
    if metric == "IP":
        return -dots
    if metric == "COSINE":
        norms = np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(block, axis=1)[None, :]
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.where(norms > 0, 1.0 - dots / norms, np.nan)
    raise ValueError(f"unknown metric {metric!r}")


# Pairs whose differences are taken at once.
_EXACT_PAIRS = 65_536


def _l2_scores(queries: np.ndarray, block: np.ndarray, k: int) -> np.ndarray:
    """Distances of the pairs that can be among the nearest ``k`` of their query, infinity for the others.

    Squared norms less twice the product are fast but cancel: they only preselect, with a bound on their rounding error.
    The survivors' distances are those of the differences."""
    norms = (queries**2).sum(1)[:, None] + (block**2).sum(1)[None, :]
    squares = norms - 2.0 * (queries @ block.T)
    error = 4 * np.finfo(np.float64).eps * (queries.shape[1] + 2) * norms
    keep = min(k, block.shape[0])
    worst = np.partition(squares + error, keep - 1, axis=1)[:, keep - 1 : keep]
    # Numbers whose squares are no finite numbers tell nothing: those pairs are all taken.
    q, c = np.nonzero(~(squares - error > worst))
    out = np.full(squares.shape, np.inf)
    for at in range(0, len(q), _EXACT_PAIRS):
        part = slice(at, at + _EXACT_PAIRS)
        out[q[part], c[part]] = np.sqrt(((queries[q[part]] - block[c[part]]) ** 2).sum(1))
    return out


# Rows of a packed block: a block of scores is the square of it in doubles, 8 MB.
BLOCK_ROWS = 1024


def _packed(df: DataFrame, id_col: str, prefix: str, block_rows: int) -> DataFrame:
    """Blocks of up to ``block_rows`` vectors: their ids and numbers as bytes, and their common length."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, block_rows):
                part = batch.slice(start, block_rows)
                sizes = pc.list_value_length(part.column(1)).to_numpy(zero_copy_only=False)
                if (sizes != sizes[0]).any():
                    raise ValueError("vectors of different lengths have no distance")
                flat = part.column(1).flatten()
                if flat.null_count or part.column(0).null_count:
                    raise ValueError("a vector with a NULL element, or without an id, has no distance")
                numbers = flat.to_numpy(zero_copy_only=False).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(sizes[0])], pa.int32()),
                        pa.array([part.column(0).to_numpy().tobytes()], pa.binary()),
                        pa.array([numbers.tobytes()], pa.binary()),
                    ],
                    [f"{prefix}_length", f"{prefix}_ids", f"{prefix}_numbers"],
                )

    rows = df.select(F.col(id_col).cast("bigint"), F.col("vector").cast("array<double>")).where("vector is not null")
    return rows.mapInArrow(pack, f"{prefix}_length int, {prefix}_ids binary, {prefix}_numbers binary")


def _nearest(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The best ``k`` scores of each row and their ids; the smaller id wins a tie, NaN is no score."""
    scores = np.where(np.isnan(scores), np.inf, scores)
    keep = min(k, scores.shape[1])
    cut = np.partition(scores, keep - 1, axis=1)[:, keep - 1 : keep]
    q, c = np.nonzero((scores <= cut) & np.isfinite(scores))  # ties on the k-th score included
    order = np.lexsort((ids[q, c], scores[q, c], q))
    q, c = q[order], c[order]
    place = np.arange(len(q)) - np.searchsorted(q, q, side="left")
    q, c, place = q[place < keep], c[place < keep], place[place < keep]
    best, near = np.full((len(scores), k), np.inf), np.zeros((len(scores), k), dtype=np.int64)
    best[q, place], near[q, place] = scores[q, c], ids[q, c]
    return best, near


def refuse_repeated(queries: DataFrame) -> None:
    """Queries are told apart by their ids."""
    again = queries.where("vector is not null").groupBy("query_id").count().where("count > 1").first()
    if again is not None:
        raise ValueError(f"query id {again.query_id} is given {again['count']} times")


def vector_topk(
    queries: DataFrame, corpus: DataFrame, *, metric: str = "L2", k: int = 10, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Exact nearest ``k`` corpus vectors per query: ``query_id, vec_id, distance, rank``.

    ``queries(query_id, vector)`` and ``corpus(vec_id, vector)``, all vectors of one length; ties go to the smaller
    ``vec_id``. A stated set of queries meets the whole corpus in packed blocks: Spark sends the query blocks to the
    tasks when they are below its broadcast limit, else it pairs partitions of blocks. A task keeps a running best ``k``
    of each query it has met and sends no more than that; a block of scores is the most it computes at once. Vectors
    without length have no cosine distance and are left out. Two queries of one id, and vectors with NULL elements, raise.
    """
    single_choice({"metric": metric}, "metric", DISTANCES)
    refuse_repeated(queries)
    # Written, so that their size is known and no pair of blocks packs them again.
    asked = written(_packed(queries, "query_id", "query", block_rows), "topk-queries")
    blocks = _packed(corpus, "vec_id", "corpus", block_rows)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running: dict[tuple[bytes, bytes], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for q_length, q_ids, q_numbers, c_length, c_ids, c_numbers in zip(*columns):
                if q_length != c_length:
                    raise ValueError("vectors of different lengths have no distance")
                matrix = np.frombuffer(q_numbers, np.float64).reshape(-1, q_length)
                scores = _scores(matrix, np.frombuffer(c_numbers, np.float64).reshape(-1, c_length), metric, k)
                ids = np.broadcast_to(np.frombuffer(c_ids, np.int64), scores.shape)
                key = (q_ids, q_numbers)
                if key in running:
                    scores = np.concatenate([running[key][0], scores], axis=1)
                    ids = np.concatenate([running[key][1], ids], axis=1)
                running[key] = _nearest(scores, ids, k)
        for (q_ids, _), (scores, near) in running.items():
            q, c = np.nonzero(np.isfinite(scores))
            distance = -scores[q, c] if metric == "IP" else scores[q, c]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.frombuffer(q_ids, np.int64)[q], pa.int64()),
                    pa.array(near[q, c], pa.int64()),
                    pa.array(distance, pa.float64()),
                ],
                ["query_id", "vec_id", "distance"],
            )

    met = asked.crossJoin(blocks).select(*asked.columns, *blocks.columns)
    found = met.mapInArrow(best, "query_id bigint, vec_id bigint, distance double")
    order = F.col("distance").desc() if metric == "IP" else F.col("distance").asc()
    # The rank filter lets Spark keep only k rows per query and task before the shuffle (window group limit).
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(order, "vec_id")))
    return ranked.where(F.col("rank") <= k)
