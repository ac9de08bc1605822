"""Quality classifier by co-training: one classifier sees the text's content, one the page's metadata; over rounds each
gives the other its confident pseudo-labels, and their calibrated views together score all documents.

Learning takes a bounded sample of labelled and of unlabelled documents; scoring is row-local over all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import toxicity
from millrace.session import written


@dataclass(frozen=True)
class Settings:
    """``max_labelled`` and ``max_pool`` bound the documents learnt from, ``per_round`` the pseudo-labels of each class
    that a view gives the other in one of ``rounds``; they must be at least ``confident``."""

    max_labelled: int = 4000
    max_pool: int = 4000
    rounds: int = 3
    per_round: int = 200
    confident: float = 0.95
    threshold: float = 0.5
    content: toxicity.Settings = toxicity.Settings(bits=18, l1=2.0, epochs=2)


@dataclass(frozen=True)
class Model:
    """Weights of both views, and the (slope, offset) that calibrates the logit of each."""

    content: np.ndarray
    content_bias: float
    metadata: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    calibration: np.ndarray
    settings: Settings


def metadata(text: str | None, lang: str | None, source: str | None) -> list[float]:
    """What a page says about itself without its words: size, shape of lines, kinds of characters, whether its language
    and source are given."""
    t = text or ""
    n, lines = max(len(t), 1), t.split("\n")
    letters = sum(map(str.isalpha, t))
    upper = sum(map(str.isupper, t))
    words = t.split()
    return [
        np.log1p(len(t)), np.log1p(len(lines)), np.log1p(n / len(lines)), letters / n, upper / max(letters, 1),
        sum(map(str.isdigit, t)) / n, sum(map(str.isspace, t)) / n, len(set(words)) / max(len(words), 1),
        len(set(lines)) / len(lines), float(bool(lang)), float(bool(source)),
    ]


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 400, rate: float = 0.5, l2: float = 1e-3) -> np.ndarray:
    """Logistic regression by full gradient steps; the last weight is the bias."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -35, 35)))
        w -= rate * (x.T @ (p - y) / len(y) + l2 * w)
    return w


def _confident(logit: np.ndarray, free: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The surest unlabelled documents of each class and their pseudo-labels."""
    edge, out, labels = np.log(settings.confident / (1 - settings.confident)), [], []
    for sign, label in ((1, 1.0), (-1, 0.0)):
        order = np.argsort(-sign * logit, kind="stable")
        sure = [i for i in order if free[i] and sign * logit[i] >= edge][: settings.per_round]
        out += sure
        labels += [label] * len(sure)
    return np.array(out, dtype=int), np.array(labels)


def co_train(rows: pd.DataFrame, settings: Settings) -> Model:
    """``rows``: text, lang, source, label (NaN for the pool), in a fixed order. Every fifth labelled row only calibrates."""
    texts = rows["text"].tolist()
    meta = np.array([metadata(*r) for r in zip(texts, rows["lang"], rows["source"])])
    centre, scale = meta.mean(axis=0), meta.std(axis=0) + 1e-6
    meta = (meta - centre) / scale
    label = rows["label"].to_numpy(dtype=float)
    known = np.flatnonzero(~np.isnan(label))
    check, known, pool = known[::5], np.setdiff1d(known, known[::5]), np.flatnonzero(np.isnan(label))
    hasher = toxicity.Hasher(settings.content.bits)
    features = [hasher.features(t) for t in texts]
    seen = {"content": (known, label[known]), "metadata": (known, label[known])}
    for turn in range(settings.rounds + 1):
        of, y = seen["content"]
        content, bias = toxicity.learn([texts[i] for i in of], y, settings.content)
        of, y = seen["metadata"]
        plain = _logistic(meta[of], y)
        logits = {
            "content": np.array([content[f].sum() + bias for f in features]),
            "metadata": meta @ plain[:-1] + plain[-1],
        }
        if turn == settings.rounds:
            break
        for teacher, pupil in (("content", "metadata"), ("metadata", "content")):
            free = np.zeros(len(texts), dtype=bool)
            free[np.setdiff1d(pool, seen[pupil][0])] = True
            new, labels = _confident(logits[teacher], free, settings)
            seen[pupil] = (np.concatenate([seen[pupil][0], new]), np.concatenate([seen[pupil][1], labels]))
    views = np.column_stack([np.clip(logits["content"][check], -20, 20), np.clip(logits["metadata"][check], -20, 20)])
    each = [_logistic(views[:, [k]] / 4, label[check], steps=800) / [4, 1] for k in (0, 1)]
    return Model(content.astype(np.float32), bias, plain, centre, scale, np.array(each), settings)


def sample(
    docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", label_col: str = "quality"
) -> DataFrame:
    """``text``, ``lang``, ``source``, ``label``: about ``max_labelled`` labelled and ``max_pool`` other documents, those
    with the smallest hashes of their ids. Ids labelled both ways, and rows without an id, take no part."""
    marks = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.min(label_col).alias("label"), F.max(label_col).alias("other"))
        .where("label = other")
        .drop("other")
    )
    marks, parts = written(marks, "quality-labels"), 1 << 40
    place = F.pmod(F.xxhash64(F.lit("quality"), "id"), F.lit(parts))
    rows = docs.select(
        F.col(id_col).alias("id"), F.col("text").cast("string"), F.col("lang").cast("string"), F.col("source").cast("string")
    ).where("id IS NOT NULL")
    n, known = rows.count(), marks.count()
    chosen = marks.where(place < parts * min(1.0, settings.max_labelled / max(known, 1)))
    labelled = rows.join(F.broadcast(chosen), "id")  # at most about max_labelled ids
    pool = rows.where(place < parts * min(1.0, settings.max_pool / max(n, 1))).join(marks.select("id"), "id", "left_anti")
    both = labelled.unionByName(pool, allowMissingColumns=True)
    one = both.groupBy("id", "label").agg(*[F.min(c).alias(c) for c in ("text", "lang", "source")])
    return written(one, "quality-sample")


def quality_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", settings: Settings = Settings()
) -> DataFrame:
    """One row per row of ``docs`` (``text``, ``lang``, ``source``): id, ``score`` (0 to 1, higher: quality 1 likelier) and
    ``kept`` (``score`` at least the threshold).

    Null and empty texts are scored by what is left of them. Without both labels in the sample every score is 1 if
    there are no labels 0, else 0. No rows give no rows; repeated rows and null ids are scored each.
    """
    rows = sample(docs, labels, settings, id_col)
    seen = {r["label"] for r in rows.select("label").distinct().collect()} - {None}
    only = docs.select(id_col, *[F.col(c).cast("string").alias(c) for c in ("text", "lang", "source")])
    if seen != {0, 1}:
        score = F.lit(0.0 if 0 in seen else 1.0)
        return only.select(id_col, score.alias("score"), (score >= settings.threshold).alias("kept"))

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        m = co_train(part.sort_values("id").reset_index(drop=True), settings)
        at = np.flatnonzero(m.content)
        lists = [at, m.content[at], m.metadata, m.centre, m.scale, m.calibration.ravel()]
        return pd.DataFrame({f"a{i}": [np.asarray(x, dtype=float)] for i, x in enumerate(lists)} | {"bias": [m.content_bias]})

    schema = ", ".join(f"a{i} array<double>" for i in range(6)) + ", bias double"
    got = rows.groupBy(F.lit(0).alias("all")).applyInPandas(lambda part: fit(part.drop(columns="all", errors="ignore")), schema).first()
    dense = np.zeros(1 << settings.content.bits, dtype=np.float32)
    dense[np.array(got["a0"], dtype=int)] = got["a1"]
    plain, centre, scale, calibration = (np.array(got[f"a{i}"]) for i in (2, 3, 4, 5))
    shared = docs.sparkSession.sparkContext.broadcast((dense, got["bias"], plain, centre, scale, calibration.reshape(2, 2)))
    bits = settings.content.bits

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        dense, bias, plain, centre, scale, calibration = shared.value
        hasher = toxicity.Hasher(bits)
        for texts, langs, sources in batches:
            if not len(texts):
                yield pd.Series([], dtype=float)
                continue
            content = np.array([float(dense[hasher.features(t)].sum()) + bias for t in texts])
            meta = (np.array([metadata(*r) for r in zip(texts, langs, sources)]) - centre) / scale
            views = np.clip(np.column_stack([content, meta @ plain[:-1] + plain[-1]]), -20, 20)
            logit = (views * calibration[:, 0] + calibration[:, 1]).mean(axis=1)
            yield pd.Series(1.0 / (1.0 + np.exp(-logit)))

    scored = only.withColumn("score", score("text", "lang", "source"))
    return scored.select(id_col, "score", (F.col("score") >= settings.threshold).alias("kept"))
