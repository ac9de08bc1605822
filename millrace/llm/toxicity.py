"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text is the set of its hashed words, word pairs and pairs with one word left out between them. Training deals a bounded
sample of the labelled texts to a few shards; each shard runs FTRL-proximal (a rate for each coordinate, L1
for sparsity) over its texts, and the shards' weights are averaged. The result is one sparse array of at most
``2**bits`` weights, which is what is sent to the tasks that score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.text import WordHasher, unused
from millrace.session import written

_WORD = re.compile(r"\w+")

# Odd multipliers that tell the kinds of features apart.
_PAIR, _SKIP, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


@dataclass(frozen=True)
class Settings:
    """``max_texts`` bounds the sample of labelled texts that is learnt from, ``bits`` the number of weights.

    ``alpha`` and ``beta`` set the rate of each coordinate, ``l1`` and ``l2`` the penalties, ``epochs`` the passes over
    a shard. There is a shard for every ``texts_per_shard`` texts, so ``max_texts / texts_per_shard`` at most."""

    bits: int = 20
    alpha: float = 4.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 0.1
    epochs: int = 4
    max_texts: int = 24_000
    texts_per_shard: int = 12_000
    threshold: float = 0.3


@dataclass(frozen=True)
class Model:
    """Sorted feature numbers and their weights, and the weight every text gets."""

    index: np.ndarray
    weight: np.ndarray
    bias: float
    settings: Settings

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.settings.bits, dtype=np.float32)
        out[self.index] = self.weight
        return out


class Hasher:
    """Texts to feature numbers."""

    def __init__(self, bits: int) -> None:
        self.shift, self.words = np.uint64(64 - bits), WordHasher()

    def features(self, text: str | None) -> np.ndarray:
        """The distinct feature numbers of a text; a null or empty text, or one without words, has none."""
        h = self.words(_WORD.findall((text or "").lower()))
        single = h * _SECOND
        if len(h) < 2:
            return np.unique((single >> self.shift).astype(np.int64))
        pairs = (h[:-1] * _PAIR) ^ (h[1:] * _SECOND)
        skips = (h[:-2] * _SKIP) ^ (h[2:] * _SECOND)
        mixed = np.concatenate([single, pairs * _SKIP, skips * _PAIR])
        return np.unique((mixed >> self.shift).astype(np.int64))


def _sigmoid(x: float) -> float:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def learn(texts: list[str | None], labels: np.ndarray, settings: Settings) -> tuple[np.ndarray, float]:
    """FTRL-proximal over one shard, in the order given; the dense weights and the bias."""
    size, s = 1 << settings.bits, settings
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    hasher = Hasher(s.bits)
    rows = [hasher.features(t).astype(np.int32) for t in texts]

    def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        live = np.abs(zi) > s.l1
        return np.where(live, -(zi - np.sign(zi) * s.l1) / ((s.beta + np.sqrt(ni)) / s.alpha + s.l2), 0.0)

    for _ in range(s.epochs):
        for row, label in zip(rows, labels):
            at = np.append(row, size)  # every feature of a text has the value 1; the last one is the bias
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            gradient = _sigmoid(float(w.sum())) - label
            squared = gradient * gradient
            z[at] = zi + gradient - (np.sqrt(ni + squared) - np.sqrt(ni)) / s.alpha * w
            n[at] = ni + squared
    w = weights(z, n)
    return w[:size], float(w[size])


def train(labelled: DataFrame, settings: Settings = Settings()) -> Model:
    """A model from a table of ``text`` and ``label`` (0 or 1; rows with another or no label are left out), which
    ``learning_rows`` keeps bounded. Without both labels among the rows the model has no weights and gives the share of
    label 1."""
    usable = labelled.where(F.col("label").isin(0, 1))
    totals = usable.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones")).first()
    n, ones = totals["n"], totals["ones"] or 0
    prior = float(np.log((ones + 0.5) / (n - ones + 0.5)))
    if not ones or ones == n:
        return Model(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.float32), prior, settings)
    draw = F.xxhash64(F.lit("toxicity"), "text")
    shards = max(2, -(-n // settings.texts_per_shard))  # an average of one learner alone would keep its noise
    shard = F.pmod(F.xxhash64(F.lit("shard"), "text"), F.lit(shards)).cast("int")

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["draw", "label"])
        w, bias = learn(part["text"].tolist(), part["label"].to_numpy(dtype=float), settings)
        at = np.flatnonzero(w)
        return pd.DataFrame({"index": [at], "weight": [w[at]], "bias": [bias], "n": [len(part)]})

    schema = "index array<long>, weight array<double>, bias double, n long"
    fitted = usable.select("text", "label", draw.alias("draw"), shard.alias("shard")).groupBy("shard").applyInPandas(fit, schema)
    total, weights, bias = 0, np.zeros(1 << settings.bits), 0.0
    for row in fitted.toLocalIterator():  # a few rows, one for each shard, of at most 2**bits weights
        weights[np.asarray(row["index"], dtype=np.int64)] += np.asarray(row["weight"]) * row["n"]
        bias, total = bias + row["bias"] * row["n"], total + row["n"]
    if not total:
        return Model(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.float32), prior, settings)
    weights, bias = weights / total, bias / total
    at = np.flatnonzero(weights)
    return Model(at, weights[at].astype(np.float32), bias, replace(settings))


def with_score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score``, the probability of label 1 from the text alone. Row-local; only texts go to Python.

    A null, empty or wordless text gets the score of the bias. Texts of any length are scored whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        dense, hasher = model.dense(), Hasher(model.settings.bits)
        for batch in batches:
            out = np.empty(len(batch))
            for k, text in enumerate(batch):
                at = hasher.features(text)
                out[k] = float(dense[at].sum(dtype=np.float64)) + model.bias
            yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(out, -35.0, 35.0))))

    return docs.withColumn(score_col, score(F.col(f"`{text_col}`").cast("string")))


def held_out(id_col: str, folds: int = 4, fold: int = 2) -> Column:
    """Whether a row is kept from learning: by the CRC-32 of its id as text (a null id: of the empty text)."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % folds == fold


def keep_harmless(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with their own columns."""
    score = unused(docs, "toxicity_score")
    model = train(learning_rows(docs, labels, id_col, text_col, settings=settings), settings)
    scored = with_score(docs, model, text_col, score)
    return scored.where(F.col(score) < settings.threshold).select(*[F.col(f"`{c}`") for c in docs.columns])


def learning_rows(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    settings: Settings = Settings(),
) -> DataFrame:
    """``id``, ``text``, ``label`` of labelled texts outside the held-out fold: about ``max_texts`` ids, those with the
    smallest hashes, so the same on every run.

    An id that is labelled both ways is left out; of an id that has several texts the smallest one counts. The sample is
    drawn from the labels, and only its ids, whose number is bounded, are broadcast to the documents.
    """
    marks = (
        labels.where(~held_out(id_col) & F.col(f"`{id_col}`").isNotNull())
        .select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"))
        .where("label IN (0, 1)")
        .groupBy("id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
        .drop("other")
    )
    marks = written(marks, "toxicity-labels")
    n = marks.count()
    if n > settings.max_texts:
        parts = 1 << 40
        marks = marks.where(F.pmod(F.xxhash64(F.lit("sample"), "id"), F.lit(parts)) < parts * settings.max_texts // n)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = texts.join(F.broadcast(marks), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    return written(rows, "toxicity-texts")
