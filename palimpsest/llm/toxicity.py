"""Operator 10: counterfactual-regularised toxicity classifier."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm import hashed, linear
from palimpsest.llm.common import give_back, is_held_out, slices, with_workers

# --- fixed values: identity terms, each list of one kind; a term is swapped for the next of its list -----
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"), ("woman", "man", "girl", "boy"), ("female", "male", "transgender", "nonbinary"),
    ("gay", "straight", "lesbian", "bisexual", "queer"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "mexican", "chinese", "indian"),
    ("immigrants", "refugees", "citizens", "foreigners"), ("old", "young"), ("disabled", "blind", "deaf"),
)
# --- end of fixed values --------------------------------------------------------------------------------
MAX_TRAIN = 8_000  # labelled documents used for the fit


def swaps(terms: Sequence[Sequence[str]] = IDENTITY_TERMS) -> dict[int, int]:
    return {hashed.term_hash(a): hashed.term_hash(b) for group in terms for a, b in zip(group, [*group[1:], group[0]])}


def telling(y: np.ndarray, f: list[np.ndarray], least: float) -> np.ndarray:
    """Features whose presence goes with the label: chi-square (1 degree of freedom) of ``least`` or more, ascending."""
    counts = np.zeros((2, 1 << linear.WORD_BITS), np.int32)  # texts that hold a feature, by label
    for label, features in zip(y, f):
        counts[int(label), features] += 1  # a text names each of its features once
    there = np.flatnonzero(counts.any(axis=0))
    a, seen = counts[1, there].astype(float), counts[:, there].sum(axis=0).astype(float)
    n, n1 = len(y), y.sum()
    spread = seen * (n - seen) * n1 * (n - n1)
    chi = n * np.maximum(np.abs(a * n - seen * n1) - n / 2, 0) ** 2 / np.maximum(spread, 1)
    return there[chi >= least]


def gradient_of(x: linear.Sparse, y: np.ndarray, own: linear.Sparse | None, swapped: linear.Sparse | None, size: int,
                penalty: float, ridge: float) -> Callable:
    """Gradient, by weights and intercept, of the mean over texts of: log loss, ``ridge`` / 2 times the squared weights,
    ``penalty`` times the squared change of the logit from ``own`` to ``swapped`` texts."""
    def gradient(w: np.ndarray) -> np.ndarray:
        p = 1 / (1 + np.exp(-np.clip(x.dot(w[:-1]) + w[-1], -30, 30)))
        g = x.back(p - y, size) + ridge * w[:-1]
        if own:
            change = own.dot(w[:-1]) - swapped.dot(w[:-1])
            g = g + 2 * penalty * (own.back(change, size) - swapped.back(change, size))
        return np.append(g, (p - y).sum()) / len(y)
    return gradient


def fit(examples: tuple, penalty: float = 10.0, ridge: float = 1.0, least: float = 20.0, steps: int = 200) -> dict:
    """A logistic regression on the presence of telling words and word beginnings: their hashes, weights, intercept.

    Beside the log loss and a ridge it pays ``penalty`` times the squared
    change of the logit between each labelled text with identity terms and the
    same text with the terms swapped, so that naming a group moves no score.
    """
    y, f, _, other = examples
    if not 0 < y.sum() < len(y):  # one label only
        return {"features": np.empty(0, np.int64), "weights": np.empty(0), "bias": -5.0 if not y.sum() else 5.0}
    keep = telling(y, f, least)
    size = len(keep)

    def chosen(vectors: list[np.ndarray]) -> linear.Sparse:
        at = [np.searchsorted(keep, v).clip(max=max(size - 1, 0)) for v in vectors]
        return linear.Sparse([p[keep[p] == v] if size else p[:0] for p, v in zip(at, vectors)])
    x = chosen(f)
    pairs = [i for i, o in enumerate(other) if o is not None]
    own, swapped = chosen([f[i] for i in pairs]), chosen([other[i] for i in pairs])
    w = linear.descend(gradient_of(x, y, pairs and own, pairs and swapped, size, penalty, ridge), np.append(np.zeros(size), np.log(y.mean() / (1 - y.mean()))), steps, 0.2)
    return {"features": keep, "weights": w[:-1], "bias": w[-1]}


def logits(col: pa.Array, model: dict) -> np.ndarray:
    """The logit of each text of a column; each feature counts once a text."""
    keep = model["features"]
    row, f = linear.presence_hashes(col)
    at = np.searchsorted(keep, f).clip(max=max(len(keep) - 1, 0))
    hit = keep[at] == f if len(keep) else np.zeros(len(f), bool)
    once = np.unique(row[hit] * max(len(keep), 1) + at[hit])
    return np.bincount(once // max(len(keep), 1), model["weights"][once % max(len(keep), 1)] if len(once) else None, minlength=len(col)) + model["bias"]


def train(docs: DataFrame, labels: DataFrame, bound: int = MAX_TRAIN, terms: Sequence[Sequence[str]] = IDENTITY_TERMS,
          penalty: float = 10.0, doc_id: str = "doc_id", text: str = "text") -> dict:
    """Fit on at most about ``bound`` labelled documents that are not held out (label ``y``, 0 or 1)."""
    with_workers(docs.sparkSession)
    known = labels.where(F.col("y").isNotNull() & ~is_held_out(F.col("doc_id")))
    sample = linear.labelled_sample(docs, known, bound, doc_id, text)
    model = fit(linear.collect_examples(sample, linear.word_presence, swaps(terms)), penalty)
    give_back()
    return model


def score(docs: DataFrame, model: dict, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` and ``score`` (0 to 1) of every whole text. Texts without words, and null, get the intercept's score."""
    spark = with_workers(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)  # at most 2^22 weights, whatever the input

    def run(col: pa.Array) -> list[np.ndarray]:
        return [1 / (1 + np.exp(-np.clip(logits(col, shared.value), -30, 30)))]
    return linear.score_column(docs, list(keep), text, "score double", run)


def toxic_labels(labels: DataFrame) -> DataFrame:
    """One label a document: toxic if any of its rows says so."""
    return labels.groupBy("doc_id").agg(F.max("toxic").alias("y"))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Null and empty texts get the intercept's score; repeated rows are judged
    alike, no rows give no rows; without labels, or with one label only, the
    score is the same for all.
    """
    return (score(docs, train(docs, toxic_labels(labels))).withColumn("held_out", is_held_out(F.col("doc_id")))
            .select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with the same columns."""
    spark = with_workers(docs.sparkSession)
    shared = spark.sparkContext.broadcast(train(docs, toxic_labels(labels)))
    schema, at = docs.schema, docs.columns.index("text")

    def run(batches):
        for b in slices(batches, at):
            yield b.filter(pa.array(logits(b.column(at), shared.value) < 0))
    return docs.mapInArrow(run, schema)
