"""Compression classifier: how much better a text compresses with a
dictionary of good texts than with one of bad texts, as a calibrated score.

Two zstandard dictionaries are built from labelled texts, one for each label.
A text's feature is the difference of its two compressed sizes, once over its
length and once over the sum of the sizes.  A logistic curve in these
differences, the compression ratio and the log length (and their products)
turns them into the probability of label 1; it is fitted on labelled texts
that neither dictionary has seen, weighted to the share of both labels.

Training reads a bounded sample: ``per_label`` rows of each label with at
most ``max_chars`` characters, chosen by a hash of doc_id and text, equal rows
once; half of them build the dictionaries, half fit the curve.  Scoring reads every whole text.

Null and empty texts are scored like any other (all sizes are those of an
empty input).  Labels that are null, or contradict each other under one
doc_id, are not learned from.  Without texts of both labels the score is the
share of label 1 (0.5 without any label).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ledgerspark.llm.common import give_back, ready, stored, text_of

DICTIONARY_BYTES = 112_640
LEVEL = 3


@dataclass
class QualityModel:
    good: bytes
    bad: bytes
    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    share: float  # of label 1; the score when there is nothing to compare with


def _dictionary(texts: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()
    except zstandard.ZstdError:  # too little text to select from: take it as it is
        return b"".join(texts)[-DICTIONARY_BYTES:]


def _compressors(model: QualityModel) -> tuple:
    return tuple(
        zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d)) for d in (model.good, model.bad)
    )


def features(texts: list[bytes], good, bad) -> np.ndarray:
    g = np.array([len(good.compress(t)) for t in texts], dtype=float)
    b = np.array([len(bad.compress(t)) for t in texts], dtype=float)
    n = np.array([len(t) for t in texts], dtype=float) + 16
    d, e, r, size = (b - g) / n, (b - g) / (b + g), np.minimum(g, b) / n, np.log(n) / 10
    return np.stack([d, e, r, size, d * d, e * e, r * r, size * size, d * r, e * r, d * size, r * size], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton's method, lightly damped."""
    z = np.c_[x, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (weight * (p - y)) + 1e-3 * w
        hessian = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step / max(1.0, np.abs(step).max() / 5)
    return w


def train(
    docs: DataFrame, labels: DataFrame, allowed: Column | None = None, per_label: int = 2000, max_chars: int = 20_000
) -> QualityModel:
    """Fit on the labelled rows of ``docs`` whose doc_id satisfies ``allowed``."""
    clean = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .where(F.lit(True) if allowed is None else allowed)
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .where("quality = other")
        .select("doc_id", "quality")
    )
    counts = {r["quality"]: r["n"] for r in clean.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = counts.get(1, 0) / sum(counts.values()) if counts else 0.5
    texts = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
        .where((F.length("text") > 0) & (F.length("text") <= max_chars))
        .withColumn("h", F.xxhash64("doc_id", "text"))
    )
    # equal rows count once; the keys alone are shuffled, not the texts
    keys = stored(texts.select("doc_id", "h").distinct().join(clean, "doc_id"), "labelled")
    picked = None
    for label in (0, 1):
        some = keys.where(F.col("quality") == label).orderBy("h", "doc_id").limit(per_label)
        picked = some if picked is None else picked.union(some)
    rows = (
        texts.join(F.broadcast(picked), ["doc_id", "h"])
        .groupBy("doc_id", "h", "quality")
        .agg(F.min("text").alias("text"))
        .collect()  # 2 * per_label rows at most
    )
    rows.sort(key=lambda r: (r["h"], r["doc_id"]))
    by = {q: [r["text"].encode("utf-8", "replace") for r in rows if r["quality"] == q] for q in (0, 1)}
    zero = QualityModel(b"", b"", np.zeros(12), np.ones(12), np.zeros(13), share)
    if min(len(by[0]), len(by[1])) < 4:
        return zero
    model = QualityModel(_dictionary(by[1][::2]), _dictionary(by[0][::2]), zero.centre, zero.spread, zero.weights, share)
    fit = {q: by[q][1::2] for q in (0, 1)}
    x = features(fit[0] + fit[1], *_compressors(model))
    y = np.repeat([0.0, 1.0], [len(fit[0]), len(fit[1])])
    weight = np.where(y == 1, share / len(fit[1]), (1 - share) / len(fit[0])) * len(y)
    model.centre, model.spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    model.weights = _logistic((x - model.centre) / model.spread, y, weight)
    return model


def score(model: QualityModel, text: Column) -> Column:
    """The probability of label 1 for each text."""
    ready()

    @F.pandas_udf(DoubleType())
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fitted = bool(model.good)
        tools = _compressors(model) if fitted else ()
        for batch in batches:
            if not fitted or not len(batch):
                yield pd.Series(np.full(len(batch), model.share))
                continue
            x = features([t.encode("utf-8", "replace") for t in batch], *tools)
            z = np.c_[(x - model.centre) / model.spread, np.ones(len(x))] @ model.weights
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        give_back()

    return scored(F.coalesce(text.cast("string"), F.lit("")))
