"""Mixing sources to target weights: repetition rates per source, whole copies plus one hash-seeded Bernoulli copy.

A source is drawn with that one of a few numbered seeds whose words come nearest to its target: a draw over few or very
uneven documents would else be far off. Which documents it takes is still decided row by row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.text import plain_words, unused
from millrace.session import written

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
SEED = "mix"
DRAWS = 16
# Words times a weight or a number of repeats outgrow 32 bits in a few GB of text.
BIG = "decimal(38,0)"


@dataclass(frozen=True)
class Shares:
    """Uncapped sources get ``weight * num / den``."""

    num: int
    den: int


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """``source``, ``source_size`` and ``rank`` (0 first, code point order, null last) of a (source, size) table.

    The table of sources is cut into ranges, so no task sorts all of them; one count per range reaches the driver.
    """
    spark = sizes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("source").isNull(), F.col("source")]
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # The ranges come from a sample; written, they stay the same for every later read.
    ranged = written(totals.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "mix-sources")
    before, offsets = 0, []
    for row in ranged.groupBy("part").count().orderBy("part").collect():  # at most `parts` rows
        offsets += [F.lit(row["part"]), F.lit(before)]
        before += row["count"]
    offset = F.create_map(*offsets)[F.col("part")] if offsets else F.lit(0)
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    return ranged.select("source", "source_size", (offset + inside).cast("long").alias("rank"))


def _weight(weights: tuple[int, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))


def shares(sources: DataFrame, max_repeats: int) -> Shares:
    """Share all words by weight, sources above ``max_repeats`` times their size stop there and the excess is shared
    again, until none is above. Each round is one aggregate; only sums reach the driver. All sums are whole numbers."""
    first = sources.agg(F.sum("source_size").alias("total"), F.sum("weight").alias("weight")).first()
    total, state, stopped = int(first["total"] or 0), Shares(int(first["total"] or 0), int(first["weight"] or 0)), -1
    while True:
        cap = F.col("source_size").cast(BIG) * max_repeats
        above = F.col("weight").cast(BIG) * F.lit(state.num).cast(BIG) > cap * F.lit(state.den).cast(BIG)
        row = sources.agg(
            F.count_if(above).alias("n"),
            F.sum(F.when(above, cap).otherwise(0)).alias("capped"),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if row["n"] == stopped or not row["weight"]:
            return state
        stopped, state = row["n"], Shares(total - int(row["capped"]), int(row["weight"]))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source``, ``source_size``, ``target`` (words, double) and ``rate`` (target by size; 0 for an empty source)."""
    sources = written(ranked_sources(sizes).withColumn("weight", _weight(weights)), "mix-ranked")
    part = shares(sources, max_repeats)
    shared = (F.col("weight").cast(BIG) * F.lit(part.num).cast(BIG)).cast("double") / F.lit(float(max(part.den, 1)))
    target = F.least(shared, (F.col("source_size").cast(BIG) * max_repeats).cast("double"))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0)
    return written(sources.select("source", "source_size", target.alias("target"), rate.alias("rate")), "mix-targets")


def uniform(key: Column, number: Column, seed: str = SEED) -> Column:
    """A number from 0 up to, not including, 1 that depends on the key and the number of the draw: 52 bits of an MD5."""
    text = F.concat(F.lit(f"{seed}:"), number.cast("string"), F.lit(":"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def _copies(rate: Column, u: Column) -> Column:
    return (F.floor(rate) + F.when(u < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def _sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    sized = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        F.size(plain_words(F.col(f"`{text_col}`"))).cast("long").alias("size"),
    )
    return written(sized, "mix-sizes")


def _with_draws(sized: DataFrame, targets: DataFrame, seed: str, draws: int) -> DataFrame:
    """``targets`` with ``draw``, for each source the one of ``draws`` numbered draws whose words come nearest to its
    target (the first of equals). One aggregate with a sum for each draw; a document's chance is the same in all."""
    joined = sized.join(targets.withColumnRenamed("source", "of_source"), F.col("source").eqNullSafe(F.col("of_source")))
    taken = [
        F.sum(F.col("size") * _copies(F.col("rate"), uniform(F.col("id"), F.lit(k), seed))).alias(f"taken{k}")
        for k in range(draws)
    ]
    sums = joined.groupBy("source").agg(F.first("target").alias("own"), *taken)
    best = F.array_min(
        F.array(*[F.struct(F.abs(F.col(f"taken{k}") - F.col("own")).alias("gap"), F.lit(k).alias("k")) for k in range(draws)])
    )
    chosen = sums.select(F.col("source").alias("of_source"), best["k"].alias("draw"))
    found = targets.join(chosen, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
    return written(found, "mix-draws")


def mix_plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    seed: str = SEED,
    draws: int = DRAWS,
) -> DataFrame:
    """One row per row of ``docs``: id, ``size`` (words), ``source_size``, ``target``, ``copies``, ``taken``.

    A null text has size 0; documents without a source are one source, last in order; a source without words has
    target 0 and no copies. The extra copy of a document depends on its id and the draw of its source only, so repeated
    ids take part alike and reruns agree; a null id counts as one id. An empty table gives no rows. Texts are read
    once; only ids, sources and sizes are written and joined. The join is Spark's choice by the written size of the
    source table.
    """
    sized = _sizes(docs, id_col, text_col, source_col)
    targets = _with_draws(sized, source_targets(sized, weights, max_repeats), seed, draws)
    joined = sized.join(targets.withColumnRenamed("source", "of_source"), F.col("source").eqNullSafe(F.col("of_source")))
    copies = _copies(F.col("rate"), uniform(F.col("id"), F.col("draw"), seed))
    return joined.select(
        F.col("id").alias(id_col),
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    seed: str = SEED,
    draws: int = DRAWS,
) -> DataFrame:
    """The mixed documents: each row of ``docs`` as many times as ``mix_plan`` says, with its own columns.

    Only rates and draws are joined to the texts: a map-side join as long as the source table is below Spark's broadcast
    limit, else a join on the source whose large partitions Spark splits.
    """
    sized = _sizes(docs, id_col, text_col, source_col)
    targets = _with_draws(sized, source_targets(sized, weights, max_repeats), seed, draws)
    of, rate, draw, copy = (unused(docs, n) for n in ("mix_source", "mix_rate", "mix_draw", "mix_copy"))
    rates = targets.select(F.col("source").alias(of), F.col("rate").alias(rate), F.col("draw").alias(draw))
    copies = _copies(F.col(rate), uniform(F.col(f"`{id_col}`"), F.col(draw), seed))
    return (
        docs.join(rates, F.col(f"`{source_col}`").cast("string").eqNullSafe(F.col(of)))
        .withColumn(copy, F.explode(F.array_repeat(F.lit(1), copies.cast("int"))))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
