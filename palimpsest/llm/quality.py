"""Operator 6: quality classifier by ordinal cumulative-link regression."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm import linear
from palimpsest.llm.common import give_back, is_held_out, with_workers

MAX_TRAIN = 8_000  # rated documents used for the fit


def thresholds(t: np.ndarray) -> np.ndarray:
    """Ordered thresholds from free parameters: the first, then positive steps."""
    return np.cumsum(np.concatenate((t[:1], np.exp(np.clip(t[1:], -20, 20)))))


def gradient_of(x: linear.Sparse, k: np.ndarray, cuts: int, size: int, ridge: float, use: np.ndarray) -> Callable:
    """Gradient, by weights and threshold parameters, of the mean of -log P(grade) plus ``ridge`` / 2 times the squared weights.

    ``use`` is 1 for weights that are fitted, 0 for others.
    """
    def gradient(p: np.ndarray) -> np.ndarray:
        th = thresholds(p[size:])
        z = x.dot(p[:size])
        edge = np.concatenate(([-np.inf], th, [np.inf]))
        hi, lo = (1 / (1 + np.exp(-np.clip(edge[k + i] - z, -30, 30))) for i in (1, 0))
        hi, lo = np.where(k == cuts, 1.0, hi), np.where(k == 0, 0.0, lo)
        p_y = np.maximum(hi - lo, 1e-9)
        d_hi, d_lo = -hi * (1 - hi) / p_y, lo * (1 - lo) / p_y  # of -log p by each of its two thresholds
        d_th = np.bincount(k, d_hi, minlength=cuts + 1)[:cuts] + np.bincount(k, d_lo, minlength=cuts + 1)[1:]
        d_t = np.cumsum(d_th[::-1])[::-1] * np.concatenate(([1.0], np.exp(np.clip(p[size + 1:], -20, 20))))
        d_w = (x.back(-(d_hi + d_lo), size) + ridge * p[:size]) * use
        return np.concatenate((d_w, d_t)) / x.n
    return gradient


def fit(examples: tuple, ridge: float = 0.5, min_docs: int = 3, steps: int = 300) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(weights, ordered thresholds, grades)`` with P(grade <= k) = sigmoid(threshold_k - weights . x).

    All grades share the weights; grades are the distinct ratings, ascending.
    """
    y, f, v, _ = examples
    size = 1 << linear.BITS
    grades = np.unique(y)
    k = np.searchsorted(grades, y)
    cuts = max(len(grades) - 1, 0)
    if not cuts:
        return np.zeros(size), np.zeros(0), grades if len(grades) else np.zeros(1)
    x = linear.Sparse(f, v)
    use = (np.bincount(x.f, minlength=size) >= min_docs).astype(float)
    below = np.clip([(k <= j).mean() for j in range(cuts)], 1e-3, 1 - 1e-3)
    logit = np.log(below / (1 - below))
    start = np.concatenate((np.zeros(size), logit[:1], np.log(np.maximum(np.diff(logit), 1e-2))))

    p = linear.descend(gradient_of(x, k, cuts, size, ridge, use), start, steps, 0.2)
    return p[:size], thresholds(p[size:]), grades


def rate(docs: DataFrame, model: tuple, at_least: float, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep``, ``expected_grade`` and ``tail_prob`` = P(grade >= at_least) of every whole text.

    An empty or null text has no features and gets what the thresholds alone say.
    """
    spark = with_workers(docs.sparkSession)
    weights, th, grades = model
    shared = spark.sparkContext.broadcast((weights.astype(np.float32), th, grades))  # 2^18 weights, whatever the input

    def run(col: pa.Array) -> list[np.ndarray]:
        w, th, grades = shared.value
        row, f, v = linear.word_rates(col)
        z = np.bincount(row, w[f] * v, minlength=len(col))
        below = np.concatenate((1 / (1 + np.exp(-np.clip(th[None, :] - z[:, None], -30, 30))), np.ones((len(col), 1))), axis=1)
        p = np.diff(below, axis=1, prepend=0.0)
        return [p @ grades, p[:, grades >= at_least].sum(axis=1).clip(0, 1)]
    return linear.score_column(docs, list(keep), text, "expected_grade double, tail_prob double", run)


def train(docs: DataFrame, ratings: DataFrame, bound: int = MAX_TRAIN, doc_id: str = "doc_id", text: str = "text") -> tuple:
    """Fit on at most about ``bound`` rated documents (``doc_id, y``) that are not held out."""
    with_workers(docs.sparkSession)
    known = ratings.where(F.col("y").isNotNull() & ~is_held_out(F.col("doc_id")))
    model = fit(linear.collect_examples(linear.labelled_sample(docs, known, bound, doc_id, text), linear.word_rates))
    give_back()
    return model


def graded(labels: DataFrame) -> DataFrame:
    """Graded ratings of labelled documents: 0 poor, 1 good but toxic, 2 good (the lowest of a document's rows)."""
    return (labels.select("doc_id", F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2).alias("y"))
            .groupBy("doc_id").agg(F.min("y").alias("y")))


def rate_documents(docs: DataFrame, labels: DataFrame, at_least: float = 1) -> DataFrame:
    """``doc_id, held_out, expected_grade, tail_prob, selected`` for every row of ``docs``.

    ``tail_prob`` is the chance of a grade of ``at_least`` or more; ``selected`` says it is 0.5 or more.
    Null and empty texts get what the thresholds alone say; repeated rows are rated alike, no rows give no rows;
    without labels every text gets grade 0 with certainty.
    """
    rated = rate(docs, train(docs, graded(labels)), at_least)
    return (rated.withColumn("held_out", is_held_out(F.col("doc_id")))
            .select("doc_id", "held_out", "expected_grade", "tail_prob", (F.col("tail_prob") >= 0.5).alias("selected")))
