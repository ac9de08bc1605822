"""Split planning by quantile sketches: key ranges of about equal row counts from one mergeable aggregate.

Keys are measured as numbers in their own order and every task summarises its keys in a KLL sketch; the sketches are merged
and their quantiles cut the table. Nothing is sampled, sorted or shuffled but the sketches, whose size does not depend on
the table. A table cut into more ranges than one sketch tells apart takes a second pass with a sketch for each coarse range.
A range that one key fills is cut further by a second key where one is given.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal
from os.path import commonprefix
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.envelope import quoted, require_columns

# Entries of a sketch, and how many ranges one sketch cuts.
SKETCH_SIZE = 16_384
RANGES_PER_SKETCH = 128
# Steps of quantiles to a range: a key of more than one step is known by its number, and ranges are put together of steps.
_FINE = 4
# Sketches of tasks are merged in so many groups before they meet.
_MERGE_GROUPS = 64

_EPOCH = datetime(1970, 1, 1)
_LETTERS, _BITS = 3, 21  # characters of a text that are measured, and the bits of one


def rank_error(size: int = SKETCH_SIZE) -> float:
    """Half the width of the interval a quantile's true rank lies in, as a share of all rows, in 99 of 100 sketches."""
    return 2.296 / size**0.9021


@dataclass(frozen=True)
class Measure:
    """Keys as numbers in the same order: the expression, the key a number stands for, the next number, and the sketch."""

    of: Callable[[Column], Column]
    key: Callable[[Any], Any]
    next: Callable[[Any], Any] = lambda n: n + 1
    sketch: str = "bigint"


def _text_key(prefix: str) -> Callable[[int], str]:
    def key(number: int) -> str:
        points = [(number >> _BITS * (_LETTERS - 1 - i)) & ((1 << _BITS) - 1) for i in range(_LETTERS)]
        # A carry into the surrogates or beyond the last character: any text will do as a boundary.
        fixed = [0xE000 if 0xD800 <= p < 0xE000 else min(p, 0x10FFFF) for p in points]
        return prefix + "".join(chr(p) for p in fixed).rstrip("\0")

    return key


def _measure(kind: T.DataType, low: Any, high: Any) -> Measure | None:
    """How keys of a type between ``low`` and ``high`` are measured; None for types without a measure."""
    if isinstance(kind, T.IntegralType):
        return Measure(lambda c: c.cast("long"), int)
    if isinstance(kind, T.DateType):
        return Measure(lambda c: F.unix_date(c).cast("long"), lambda n: date(1970, 1, 1) + timedelta(days=n))
    if isinstance(kind, T.TimestampType):
        return Measure(F.unix_micros, lambda n: _EPOCH + timedelta(microseconds=n))
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        shift = Decimal(10) ** kind.scale
        return Measure(lambda c: (c * F.lit(10**kind.scale)).cast("long"), lambda n: Decimal(n) / shift)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return Measure(lambda c: c.cast("double"), float, lambda n: math.nextafter(n, math.inf), "double")
    if isinstance(kind, T.StringType):
        prefix = commonprefix([low, high])
        letter = lambda c, i: F.ascii(F.substring(c, len(prefix) + 1 + i, 1)).cast("long")
        return Measure(
            lambda c: sum((F.shiftleft(letter(c, i), _BITS * (_LETTERS - 1 - i)) for i in range(1, _LETTERS)), F.shiftleft(letter(c, 0), _BITS * (_LETTERS - 1))),
            _text_key(prefix),
        )
    return None


def _sketch_functions(measure: Measure) -> tuple[Callable, Callable, Callable]:
    if measure.sketch == "double":
        return F.kll_sketch_agg_double, F.kll_merge_agg_double, F.kll_sketch_get_quantile_double
    return F.kll_sketch_agg_bigint, F.kll_merge_agg_bigint, F.kll_sketch_get_quantile_bigint


def _quantiles(df: DataFrame, measure: Measure, key: Column, parts: int, group: Column, size: int) -> dict[Any, list]:
    """The inner quantiles of the measured key in each group, ``_FINE`` steps to a part."""
    sketch, merge, quantile = _sketch_functions(measure)
    measured = df.select(group.alias("g"), measure.of(key).alias("m"), F.pmod(F.spark_partition_id(), F.lit(_MERGE_GROUPS)).alias("s"))
    partial = measured.where(F.col("m").isNotNull()).groupBy("g", "s").agg(sketch("m", size).alias("k"))
    merged = partial.groupBy("g").agg(merge("k", size).alias("k"))
    ranks = F.array(*[F.lit(i / (parts * _FINE)) for i in range(1, parts * _FINE)])
    return {r.g: list(r.q) for r in merged.select("g", quantile("k", ranks).alias("q")).collect()}


@dataclass(frozen=True)
class KeyRange:
    """Rows with ``low <= key < high`` (None: open); of one key, those with ``second_low <= second key < second_high``."""

    low: Any = None
    high: Any = None
    second_low: Any = None
    second_high: Any = None
    of_one_key: bool = False


def _ends(df: DataFrame, key: Column) -> tuple[Any, Any, int]:
    row = df.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(key).alias("n")).first()
    return row.low, row.high, row.n


def _inside(df: DataFrame, key: Column, low: Any, high: Any, kind: T.DataType) -> DataFrame:
    """Rows of a key range, as a filter that reaches the scan."""
    if low is not None:
        df = df.where(key >= F.lit(low).cast(kind))
    return df if high is None else df.where(key < F.lit(high).cast(kind))


def sketch_ranges(
    df: DataFrame, column: str, splits: int, *, second: str | None = None, size: int = SKETCH_SIZE, per_sketch: int = RANGES_PER_SKETCH
) -> list[KeyRange]:
    """About ``splits`` ranges of ``column`` with about equal row counts, which together hold every key once.

    A range is wrong by twice ``rank_error(size)`` of the rows a sketch saw: all rows, or in a second pass those of a coarse
    range. A key with more rows than a range is a range of its own, cut by the quantiles of ``second`` where that is given.
    A type without a measure (binary, nested) raises."""
    require_columns(df, [column, *([second] if second else [])], "sketch_ranges")
    low, high, rows = _ends(df, F.col(quoted(column)))
    if rows == 0 or splits < 2:
        return [KeyRange()]
    return _cut(df, column, splits, low, high, KeyRange(), second, size, per_sketch)


def _cut(df: DataFrame, column: str, splits: int, low: Any, high: Any, whole: KeyRange, second: str | None, size: int, per_sketch: int) -> list[KeyRange]:
    """Ranges of the rows of ``df``, all inside ``whole``, whose keys go from ``low`` to ``high``."""
    key, kind = F.col(quoted(column)), df.schema[column].dataType
    if low == high:
        return _cut_one_key(df, low, splits, whole, second, size, per_sketch)
    measure = _measure(kind, low, high)
    if measure is None:
        raise ValueError(f"keys of type {kind.simpleString()} have no measure: {column}")
    parts = min(splits, per_sketch)
    found = _quantiles(df, measure, key, parts, F.lit(0), size)[0]
    coarse = _between(found, parts, splits, measure, whole)
    if all(share == 1 and not full for _, share, full in coarse):
        return [piece for piece, _, _ in coarse]
    finer = [(piece, share) for piece, share, full in coarse if share > 1 and not full]
    cuts: dict[int, list] = {}
    if finer:
        # One pass for all coarse ranges; each has a sketch of its own.
        number = _number(key, [piece for piece, _ in finer], kind)
        inner = max(share for _, share in finer)
        quantiles = _quantiles(df.where(number.isNotNull()), measure, key, inner, number, size)
        for i, (_, share) in enumerate(finer):
            # Fewer parts than the largest range: every so many-th quantile.
            at = quantiles.get(i, [])
            cuts[i] = [at[round(j * inner / share) - 1] for j in range(1, share * _FINE)] if at else []
    out: list[KeyRange] = []
    for piece, share, full in coarse:
        if share > 1 and not full:
            out += [p for p, _, _ in _between(cuts[[f for f, _ in finer].index(piece)], share, share, measure, piece)]
        elif full:
            inside = _inside(df, key, piece.low, piece.high, kind)
            least, most, rows = _ends(inside, key)
            out += _cut(inside, column, share, least, most, piece, second, size, per_sketch) if rows and share > 1 else [piece]
        else:
            out.append(piece)
    return out


def _atoms(found: Sequence[Any], measure: Measure, whole: KeyRange) -> list[tuple[Any, Any, int, bool]]:
    """What lies between neighbouring quantiles: low, high, how many of their steps it holds, and whether one number fills
    it."""
    out: list[tuple[Any, Any, int, bool]] = []
    start, steps, i = whole.low, 0, 0
    while i < len(found):
        run = i
        while run + 1 < len(found) and found[run + 1] == found[i]:
            run += 1
        here, beyond = measure.key(found[i]), measure.key(measure.next(found[i]))
        if start is None or here > start:  # else the number is the least there is: nothing lies before it
            out.append((start, here, steps + 1, False))
            start, steps = here, 0
        else:
            steps += 1
        if run > i and beyond > here and (whole.high is None or beyond < whole.high):
            out.append((here, beyond, run - i + steps, True))
            start, steps = beyond, 0
        else:
            steps += run - i
        i = run + 1
    return [*out, (start, whole.high, steps + 1, False)]


def _between(found: Sequence[Any], parts: int, splits: int, measure: Measure, whole: KeyRange) -> list[tuple[KeyRange, int, bool]]:
    """Ranges of ``_FINE`` steps between quantiles: each with its share of the ``splits``, and whether one number that is
    more than a range fills it."""
    share = splits / parts / _FINE
    out: list[tuple[KeyRange, int, bool]] = []
    waiting: list[tuple[Any, Any, int, bool]] = []

    def close() -> None:
        if waiting:
            steps = sum(atom[2] for atom in waiting)
            out.append((KeyRange(waiting[0][0], waiting[-1][1]), max(1, round(steps * share)), False))
            waiting.clear()

    for atom in _atoms(found, measure, whole):
        hot = atom[3] and atom[2] > _FINE
        if hot or sum(a[2] for a in waiting) + atom[2] > _FINE:
            close()
        if hot:
            out.append((KeyRange(atom[0], atom[1]), max(1, round(atom[2] * share)), True))
        else:
            waiting.append(atom)
    close()
    return out


def _number(key: Column, pieces: Sequence[KeyRange], kind: T.DataType) -> Column:
    """The place of a key's range among ``pieces``, NULL in none: a binary search written as nested conditions."""

    def side(low: int, high: int) -> Column:
        if high - low == 1:
            piece, inside = pieces[low], F.lit(True)
            if piece.low is not None:
                inside = inside & (key >= F.lit(piece.low).cast(kind))
            if piece.high is not None:
                inside = inside & (key < F.lit(piece.high).cast(kind))
            return F.when(inside, F.lit(low))
        middle = (low + high) // 2
        return F.when(key < F.lit(pieces[middle].low).cast(kind), side(low, middle)).otherwise(side(middle, high))

    return side(0, len(pieces))


def _cut_one_key(df: DataFrame, value: Any, splits: int, whole: KeyRange, second: str | None, size: int, per_sketch: int) -> list[KeyRange]:
    """Ranges of the second key inside one key."""
    if second is None or splits < 2:
        return [whole]
    inner = sketch_ranges(df, second, splits, size=size, per_sketch=per_sketch)
    return [replace(whole, second_low=r.low, second_high=r.high, of_one_key=True) for r in inner]


def range_conditions(ranges: Sequence[KeyRange], column: str, second: str | None = None) -> list[str]:
    """One SQL condition per range; together they select every row once. Rows without a key go with the first range, rows of
    a key without a second key with the first of that key's."""
    from millrace.plans.splits import sql_literal

    out = []
    for i, r in enumerate(ranges):
        parts = [f"{column} >= {sql_literal(r.low)}"] if r.low is not None else []
        parts += [f"{column} < {sql_literal(r.high)}"] if r.high is not None else []
        if r.of_one_key:
            inner = [f"{second} >= {sql_literal(r.second_low)}"] if r.second_low is not None else []
            inner += [f"{second} < {sql_literal(r.second_high)}"] if r.second_high is not None else []
            joined = " AND ".join(inner) or "1 = 1"
            parts.append(f"(({joined}) OR {second} IS NULL)" if r.second_low is None else f"({joined})")
        if r.of_one_key and r.low is None and r.high is None and i:
            parts.append(f"{column} IS NOT NULL")
        condition = " AND ".join(parts) or "1 = 1"
        # Without a key no part is true: the first range takes such rows, whatever their second key.
        out.append(f"({condition}) OR {column} IS NULL" if i == 0 and parts else condition)
    return out
