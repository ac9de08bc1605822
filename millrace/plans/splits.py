"""Planning parallel reads of a keyed table: which key ranges become partitions.

Only aggregates reach the driver (minimum, maximum, count, one boundary per split).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, functions as F

from millrace.envelope import quoted, require_columns

# Defaults of the split options.
SPLIT_SIZE = 8096
EVEN_LOWER_BOUND = 0.05
EVEN_UPPER_BOUND = 100.0
SAMPLE_SHARDING_THRESHOLD = 1000
INVERSE_SAMPLING_RATE = 1000

# Keys looked at per planned range: enough for even ranges, and a bound on what is shuffled to find them.
KEYS_PER_SPLIT = 100

Bounds = list[tuple[Any, Any]]


def key_statistics(df: DataFrame, column: str) -> tuple[Any, Any, int]:
    """(minimum, maximum, rows with a key) in one aggregation."""
    require_columns(df, [column], "key_statistics")
    key = F.col(quoted(column))
    row = df.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(key).alias("n")).first()
    return row["low"], row["high"], row["n"]


def even_bounds(low: int, high: int, step: int) -> Bounds:
    """Half-open ranges of one width; the first and the last are open ended, so they cover every key."""
    cuts = list(range(low + step, high + 1, step))
    return list(zip([None, *cuts], [*cuts, None]))


def bounds_of(firsts: Sequence[Any]) -> Bounds:
    """Half-open ranges from the smallest key of each; equal ones are one range."""
    cuts = sorted(set(firsts))[1:]
    return list(zip([None, *cuts], [*cuts, None]))


def sampled_bounds(
    df: DataFrame, column: str, splits: int, rows: int, fraction: float = 1.0, keys_per_split: int = KEYS_PER_SPLIT
) -> Bounds:
    """Ranges of about equal row counts, for skewed or text keys.

    At most about ``keys_per_split`` keys per range are sampled, so finding the ranges stays small however large the
    table or its hottest key is. Spark's range partitioner orders the sample; only the smallest key of each range
    comes back. A key is never cut, so one hot key is one split.
    """
    key = F.col(quoted(column))
    keys = df.select(key.alias("k")).where(key.isNotNull())
    fraction = min(fraction, keys_per_split * splits / max(rows, 1))
    if fraction < 1:
        keys = keys.sample(fraction=fraction, seed=7)
    firsts = (
        keys.repartitionByRange(max(1, splits), "k")
        .groupBy(F.spark_partition_id().alias("p"))
        .agg(F.min("k").alias("k"))
        .orderBy("k")
        .collect()
    )
    return bounds_of([row["k"] for row in firsts])


def plan_splits(
    df: DataFrame,
    column: str,
    *,
    split_size: int = SPLIT_SIZE,
    even_lower: float = EVEN_LOWER_BOUND,
    even_upper: float = EVEN_UPPER_BOUND,
    sample_sharding_threshold: int = SAMPLE_SHARDING_THRESHOLD,
    inverse_sampling_rate: int = INVERSE_SAMPLING_RATE,
    max_splits: int | None = None,
    keys_per_split: int = KEYS_PER_SPLIT,
) -> Bounds:
    """Key ranges holding about ``split_size`` rows each.

    The distribution factor is (max - min + 1) / rows. Integer keys whose factor lies between the two bounds are
    dense enough for ranges of one width, computed without touching the data again. Other keys (skewed, or text)
    take ranges of equal row counts; above ``sample_sharding_threshold`` splits these come from a sample of one in
    ``inverse_sampling_rate`` rows, of ``keys_per_split`` keys for each range at most. With ``max_splits`` a table that
    would need more gets wider ones.
    """
    low, high, rows = key_statistics(df, column)

    def cuts(splits: int) -> Bounds:
        fraction = 1 / inverse_sampling_rate if splits > sample_sharding_threshold else 1.0
        return sampled_bounds(df, column, splits, rows, fraction, keys_per_split)

    return ranges_of(low, high, rows, cuts, split_size, even_lower, even_upper, max_splits)


def ranges_of(
    low: Any,
    high: Any,
    rows: int,
    cuts: Callable[[int], Bounds],
    split_size: int = SPLIT_SIZE,
    even_lower: float = EVEN_LOWER_BOUND,
    even_upper: float = EVEN_UPPER_BOUND,
    max_splits: int | None = None,
) -> Bounds:
    """The ranges for known key statistics; ``cuts`` finds ranges of equal row counts where even ones will not do."""
    if max_splits:
        split_size = max(split_size, -(-rows // max_splits))
    if rows <= split_size or low == high:
        return [(None, None)]
    if isinstance(low, int) and not isinstance(low, bool):
        factor = (high - low + 1) / rows
        if even_lower <= factor <= even_upper:
            return even_bounds(low, high, max(1, int(factor * split_size)))
    return cuts(-(-rows // split_size))


def sql_literal(value: Any) -> str:
    """A key value as a SQL literal."""
    if isinstance(value, (bool, int, float, Decimal)):
        return str(value)
    if isinstance(value, (date, datetime)):
        return "'" + value.isoformat(sep=" ") + "'" if isinstance(value, datetime) else f"'{value.isoformat()}'"
    return "'" + str(value).replace("'", "''") + "'"


def split_predicates(column: str, bounds: Sequence[tuple[Any, Any]]) -> list[str]:
    """One SQL condition per range. Together they select every row once: ranges are half open, and rows without a key
    go with the first."""
    out = []
    for i, (low, high) in enumerate(bounds):
        parts = []
        if low is not None:
            parts.append(f"{column} >= {sql_literal(low)}")
        if high is not None:
            parts.append(f"{column} < {sql_literal(high)}")
        condition = " AND ".join(parts) or "1 = 1"
        out.append(f"({condition}) OR {column} IS NULL" if i == 0 and parts else condition)
    return out


def split_number(df: DataFrame, column: str, bounds: Sequence[tuple[Any, Any]]):
    """The split (0-based) each row falls into, by the planned ranges."""
    key = F.col(quoted(column))
    cuts = [low for low, _ in bounds if low is not None]
    if not cuts:
        return F.lit(0)
    kind = df.schema[column].dataType
    passed = F.array(*[F.lit(cut).cast(kind) for cut in cuts])
    return F.when(key.isNull(), 0).otherwise(F.size(F.filter(passed, lambda cut: cut <= key)))
