"""An approximate vector index of inverted lists: build, store, search.

Centers are fitted on a bounded sample; every vector of the corpus goes into the list of its nearest center, and the lists
are written as folders. A search visits the ``probes`` lists whose centers are nearest to a query: queries and vectors meet on
the list number, an equality join of packed blocks, and the distances of the vectors met are exact. So a search reads and
compares ``probes / lists`` of the corpus; what it can miss are neighbours in lists it does not visit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from millrace.functions.vectors import BLOCK_ROWS, DISTANCES, _nearest, _scores, refuse_repeated
from millrace.options import single_choice
from millrace.session import written

# Bounds of the sample that centers are fitted on: vectors for each list, and in all.
SAMPLE_PER_LIST = 64
MOST_SAMPLED = 100_000
ROUNDS = 12
# Vectors of a list that one task writes: a large list is several files.
ROWS_PER_FILE = 1_000_000


@dataclass(frozen=True)
class IvfIndex:
    """Where the lists are, their centers, and the metric they were made for."""

    path: str
    metric: str
    centers: np.ndarray

    def save(self, spark: SparkSession) -> None:
        rows = [(i, center.tolist()) for i, center in enumerate(self.centers)]
        stored = spark.createDataFrame(rows, "list int, center array<double>").withColumn("metric", F.lit(self.metric))
        stored.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/centers")

    @staticmethod
    def open(spark: SparkSession, path: str) -> "IvfIndex":
        rows = spark.read.parquet(f"{path}/centers").orderBy("list").collect()
        return IvfIndex(path, rows[0].metric, np.array([r.center for r in rows]))

    def lists(self, spark: SparkSession) -> DataFrame:
        """``vec_id, vector, list`` of the whole corpus."""
        return spark.read.schema("vec_id bigint, vector array<double>, list int").parquet(f"{self.path}/lists")


def _directed(vectors: np.ndarray, metric: str) -> np.ndarray:
    """Under the cosine distance only directions count; a vector without length keeps its zeros."""
    if metric != "COSINE":
        return vectors
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)


def fit_centers(corpus: DataFrame, lists: int, *, metric: str = "L2", seed: int = 7) -> np.ndarray:
    """``lists`` centers by k-means over a sample: the vectors with the least hashes of their ids, ``SAMPLE_PER_LIST`` for each
    list and ``MOST_SAMPLED`` at most, so the sample is the same in every run. Fewer vectors give fewer centers."""
    wanted = min(MOST_SAMPLED, SAMPLE_PER_LIST * lists)
    usable = corpus.where("vector is not null").select("vec_id", F.col("vector").cast("array<double>").alias("vector"))
    drawn = usable.withColumn("h", F.xxhash64("vec_id", F.lit(seed))).orderBy("h", "vec_id").limit(wanted).collect()
    if not drawn:
        return np.empty((0, 0))
    sample = _directed(np.array([r.vector for r in drawn], dtype=np.float64), metric)
    rng, centers = np.random.default_rng(seed), sample[:1]
    # Each next center is drawn by its squared distance from those there are.
    gap = ((sample - centers[0]) ** 2).sum(1)
    while len(centers) < lists and gap.max() > 0:
        pick = rng.choice(len(sample), p=gap / gap.sum())
        centers = np.vstack([centers, sample[pick]])
        gap = np.minimum(gap, ((sample - sample[pick]) ** 2).sum(1))
    for _ in range(ROUNDS):
        home = _home(sample, centers)
        sums = np.zeros_like(centers)
        np.add.at(sums, home, sample)
        count = np.bincount(home, minlength=len(centers))
        moved = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centers)
        if np.allclose(moved, centers):
            break
        centers = moved
    return centers


def _gaps(vectors: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances less the vector's own square: enough to compare centers."""
    return (centers**2).sum(1)[None, :] - 2.0 * vectors @ centers.T


def _home(vectors: np.ndarray, centers: np.ndarray) -> np.ndarray:
    step = max(1, 4_000_000 // max(1, len(centers)))
    parts = [_gaps(vectors[i : i + step], centers).argmin(1) for i in range(0, len(vectors), step)]
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    sizes = np.unique(pc.list_value_length(column).to_numpy(zero_copy_only=False))
    flat = column.flatten()
    if len(sizes) != 1 or flat.null_count:
        raise ValueError("vectors of different lengths, or with NULL elements, have no distance")
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, int(sizes[0]))


def build_index(
    corpus: DataFrame, path: str, *, lists: int, metric: str = "L2", rows_per_file: int = ROWS_PER_FILE, seed: int = 7
) -> IvfIndex:
    """Index ``corpus(vec_id, vector)`` under ``path``. Every vector that is not NULL is in one list. A list with very many
    vectors is written by several tasks: their number follows from the counted lists."""
    single_choice({"metric": metric}, "metric", DISTANCES)
    spark, centers = corpus.sparkSession, fit_centers(corpus, lists, metric=metric, seed=seed)
    index = IvfIndex(path, metric, centers)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                home = _home(_directed(_matrix(batch.column(1)), metric), centers)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home, pa.int32())], ["vec_id", "vector", "list"])

    rows = corpus.select(F.col("vec_id").cast("bigint"), F.col("vector").cast("array<double>")).where("vector is not null")
    homed = rows.mapInArrow(assign, "vec_id bigint, vector array<double>, list int")
    counted = homed.groupBy("list").count().collect()  # one row a list
    files = {r.list: -(-r["count"] // rows_per_file) for r in counted}
    salt = F.lit(0)
    for number, many in files.items():
        if many > 1:
            salt = F.when(F.col("list") == number, F.pmod(F.xxhash64("vec_id"), F.lit(many))).otherwise(salt)
    dealt = homed.repartition(max(1, sum(files.values())), "list", salt)
    dealt.sortWithinPartitions("list", "vec_id").write.mode("overwrite").partitionBy("list").parquet(f"{path}/lists")
    index.save(spark)
    return index


def _blocks(df: DataFrame, id_col: str, prefix: str, block_rows: int) -> DataFrame:
    """Rows of ``id_col, vector, list`` as blocks of one list each: list, ids and numbers as bytes, vector length."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2).to_numpy()
            cuts = np.flatnonzero(np.append(True, lists[1:] != lists[:-1])).tolist() if len(lists) else []
            for start, end in zip(cuts, [*cuts[1:], len(lists)]):
                for at in range(start, end, block_rows):
                    part = batch.slice(at, min(block_rows, end - at))
                    numbers = _matrix(part.column(1))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([int(lists[at])], pa.int32()),
                            pa.array([numbers.shape[1]], pa.int32()),
                            pa.array([part.column(0).to_numpy().tobytes()], pa.binary()),
                            pa.array([numbers.tobytes()], pa.binary()),
                        ],
                        ["list", f"{prefix}_length", f"{prefix}_ids", f"{prefix}_numbers"],
                    )

    return df.select(id_col, "vector", "list").mapInArrow(pack, f"list int, {prefix}_length int, {prefix}_ids binary, {prefix}_numbers binary")


def search(
    spark: SparkSession, index: IvfIndex, queries: DataFrame, *, k: int = 10, probes: int = 8, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """The nearest ``k`` vectors of each query among the lists it visits: ``query_id, vec_id, distance, rank``. Distances are
    exact, ties go to the smaller id; with as many probes as lists the result is exact. Two queries of one id raise; queries
    without a vector are left out."""
    refuse_repeated(queries)
    centers, metric = index.centers, index.metric
    near = min(probes, len(centers))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not near:
                continue
            vectors = _directed(_matrix(batch.column(1)), metric)
            # By inner product the most promising lists are those whose centers have the largest product.
            gaps = -(vectors @ centers.T) if metric == "IP" else _gaps(vectors, centers)
            lists = np.argpartition(gaps, near - 1, axis=1)[:, :near].astype(np.int32)
            at = pa.array(np.repeat(np.arange(len(vectors)), near))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(lists.ravel())], ["query_id", "vector", "list"]
            )

    asked = queries.select(F.col("query_id").cast("bigint"), F.col("vector").cast("array<double>")).where("vector is not null")
    probing = asked.mapInArrow(probe, "query_id bigint, vector array<double>, list int")
    # Queries of one list side by side, so that its blocks are compared with many queries at once; written, so that the lists
    # to read are known before the corpus is opened (one number a list).
    probing = written(probing.repartition("list").sortWithinPartitions("list", "query_id"), "ivf-probes")
    visited = [r.list for r in probing.select("list").distinct().collect()]
    lists = index.lists(spark).where(F.col("list").isin(visited))
    met = _blocks(probing, "query_id", "query", block_rows).join(_blocks(lists, "vec_id", "corpus", block_rows), "list")

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running: dict[tuple[int, bytes], tuple[np.ndarray, np.ndarray]] = {}

        def found() -> Iterator[pa.RecordBatch]:
            for (_, q_ids), (scores, ids) in running.items():
                q, c = np.nonzero(np.isfinite(scores))
                distance = -scores[q, c] if metric == "IP" else scores[q, c]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(q_ids, np.int64)[q]), pa.array(ids[q, c], pa.int64()), pa.array(distance, pa.float64())],
                    ["query_id", "vec_id", "distance"],
                )
            running.clear()

        size = 0
        for batch in batches:
            for number, q_length, q_ids, q_numbers, c_length, c_ids, c_numbers in zip(*[c.to_pylist() for c in batch.columns]):
                if q_length != c_length:
                    raise ValueError("vectors of different lengths have no distance")
                asked = np.frombuffer(q_numbers, np.float64).reshape(-1, q_length)
                scores = _scores(asked, np.frombuffer(c_numbers, np.float64).reshape(-1, c_length), metric, k)
                ids = np.broadcast_to(np.frombuffer(c_ids, np.int64), scores.shape)
                key = (number, q_ids)
                if key in running:
                    scores = np.concatenate([running[key][0], scores], axis=1)
                    ids = np.concatenate([running[key][1], ids], axis=1)
                else:
                    size += len(asked)
                running[key] = _nearest(scores, ids, k)
            if size * k > 4_000_000:  # what is held stays bounded; a query's best of several parts are ranked below
                yield from found()
                size = 0
        yield from found()

    results = met.mapInArrow(best, "query_id bigint, vec_id bigint, distance double")
    order = F.col("distance").desc() if metric == "IP" else F.col("distance").asc()
    ranked = results.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(order, "vec_id")))
    return ranked.where(F.col("rank") <= k)
