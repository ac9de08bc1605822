"""A training corpus from raw documents: harmless, well-formed, without near duplicates, free of benchmark text, mixed.

Each stage takes what its predecessor kept, as a table, and returns the rows it keeps with their columns. The last one
returns a row as often as the mix repeats it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.decontaminate import keep_clean
from millrace.llm.mixing import mix
from millrace.llm.neardup import keep_first
from millrace.llm.quality import keep_by_quality
from millrace.llm.toxicity import keep_harmless
from millrace.session import ship_package, written
from workloads.registry import SESSION_CONF, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go. The model learns from the labelled ones among them."""
    _prepare(spark)
    return keep_harmless(docs, table(spark, sf_dir, "labels"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a quality rule go."""
    _prepare(spark)
    return keep_by_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    _prepare(spark)
    return keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark window go."""
    _prepare(spark)
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated, or left out, as the target weights of their sources ask."""
    _prepare(spark)
    return mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("quality rules", quality),
    ("near-dedup", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
]

# The classifier and the sampled signatures have no SQL form; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def _prepare(spark: SparkSession) -> None:
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    ship_package(spark)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; between stages the rows are written to the shared scratch folder."""
    _prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
