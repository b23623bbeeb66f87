"""Sparse hashed-text features and the plain numpy fitting shared by the two linear classifiers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm import hashed
from palimpsest.llm.common import schema_of, slices

BITS = 18  # rates are hashed to 2^18 weights
WORD_BITS = 22  # words and their beginnings are hashed to 2^22


def presence_hashes(col: pa.Array, swap: dict[int, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``(row, feature)`` of every word and of its first 3 to 7 bytes where it is longer; pairs may repeat.

    Words are runs of letters and digits, A-Z lower-cased. With ``swap`` a
    word whose hash is a key stands for the word of the value's hash.
    """
    w = hashed.Words(col, hashed.MARKS)
    s, inverse = hashed.prefix_sums(w.data), hashed.powers(hashed._INVERSE, len(w.data) + 1)
    h, length = w.hash, w.end - w.start
    if swap:
        keys = np.array(sorted(swap), np.uint64)
        at = np.searchsorted(keys, h).clip(max=len(keys) - 1)
        hit = keys[at] == h
        h, length = np.where(hit, np.array([swap[int(k)] for k in keys], np.uint64)[at], h), np.where(hit, 0, length)
    rows, out = [w.row], [h]
    for n in range(3, 8):
        longer = np.flatnonzero(length > n)
        at = w.start[longer]
        rows.append(w.row[longer])
        out.append(hashed.mix((s[at + n] - s[at]) * inverse[at] + np.uint64(n << 32)))
    return np.concatenate(rows).astype(np.int64), (np.concatenate(out) >> np.uint64(64 - WORD_BITS)).astype(np.int64)


def word_presence(col: pa.Array, swap: dict[int, int] | None = None) -> tuple[np.ndarray, np.ndarray, None]:
    """``(row, feature, None)``, sorted, for each distinct feature of a row; its value is 1."""
    row, f = presence_hashes(col, swap)
    pairs = np.unique(row << WORD_BITS | f)
    return pairs >> WORD_BITS, pairs & ((1 << WORD_BITS) - 1), None


def word_rates(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, feature, value)``: the root of each feature's share of the row's words.

    Features of a word: itself (letters and digits, lower-cased), its shape
    (classes of its first and last two bytes), and whether it repeats the word before.
    """
    w = hashed.Words(col, hashed.SPACES, lower=False)
    n = len(w.hash)
    kind = np.arange(256, dtype=np.uint64)
    kind[97:123], kind[65:91], kind[48:58], kind[128:] = 97, 65, 48, 97
    shape = np.zeros(n, np.uint64)
    if n:
        for at in (w.start, w.end - 1, np.maximum(w.start, w.end - 2)):
            shape = shape * np.uint64(257) + kind[w.data[at]]
    shape = hashed.mix(shape + np.uint64(1 << 40))
    again = np.zeros(n, bool)
    again[1:] = (w.hash[1:] == w.hash[:-1]) & (w.row[1:] == w.row[:-1])
    plain = hashed.Words(col, hashed.MARKS)
    repeated = hashed.mix(np.full(int(again.sum()), 1 << 41, np.uint64))
    row = np.concatenate((w.row, w.row[again], plain.row)).astype(np.int64)
    h = np.concatenate((shape, repeated, plain.hash))
    pairs, n_of = np.unique(row << BITS | (h >> np.uint64(64 - BITS)).astype(np.int64), return_counts=True)
    row = pairs >> BITS
    return row, pairs & ((1 << BITS) - 1), np.sqrt(n_of / np.maximum(w.counts()[row], 1))


def collect_examples(texts: DataFrame, features: Callable, swap: dict[int, int] | None = None) -> tuple:
    """Feature vectors of a bounded set of labelled texts (columns ``y``, ``text``), made in tasks.

    Returns ``y`` and per example ``(features, values)``, values being None
    where all are 1, and for examples that hold a term of ``swap`` the features
    with the terms swapped.
    """
    def run(batches: Iterator) -> Iterator:
        for b in slices(batches, 1):
            col = b.column(1)
            row, f, v = features(col)
            cut = np.searchsorted(row, np.arange(b.num_rows + 1))
            other = [None] * b.num_rows
            if swap:
                r2, f2, _ = features(col, swap)
                cut2 = np.searchsorted(r2, np.arange(b.num_rows + 1))
                for i in range(b.num_rows):
                    x = f2[cut2[i]:cut2[i + 1]]
                    if not np.array_equal(x, f[cut[i]:cut[i + 1]]):
                        other[i] = x.astype(np.int32).tobytes()
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([f[a:z].astype(np.int32).tobytes() for a, z in zip(cut, cut[1:])], pa.binary()),
                pa.array([None if v is None else v[a:z].astype(np.float32).tobytes() for a, z in zip(cut, cut[1:])], pa.binary()),
                pa.array(other, pa.binary())], names=["y", "f", "v", "other"])
    rows = texts.select(F.col("y").cast("double"), "text").mapInArrow(run, "y double, f binary, v binary, other binary").collect()
    rows.sort(key=lambda r: (r["f"], r["v"] or b"", r["y"]))  # the fit doesn't depend on the order of tasks
    return (np.array([r["y"] for r in rows]), [np.frombuffer(r["f"], np.int32) for r in rows],
            [None if r["v"] is None else np.frombuffer(r["v"], np.float32) for r in rows],
            [None if r["other"] is None else np.frombuffer(r["other"], np.int32) for r in rows])


class Sparse:
    """Rows of sparse vectors with products by a weight vector from either side."""

    def __init__(self, features: list[np.ndarray], values: list[np.ndarray] | None = None):
        self.n = len(features)
        self.row = np.repeat(np.arange(self.n), [len(f) for f in features])
        self.f = np.concatenate(features) if features else np.empty(0, np.int64)
        self.v = np.concatenate(values).astype(float) if values else np.ones(len(self.f))

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.v * w[self.f], minlength=self.n)

    def back(self, g: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.f, self.v * g[self.row], minlength=size)


def descend(gradient: Callable, start: np.ndarray, steps: int, rate: float) -> np.ndarray:
    """Adam with a rate that falls to zero."""
    x, m, s = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for t in range(1, steps + 1):
        g = gradient(x)
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        x -= rate * (1 - (t - 1) / steps) * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.99 ** t)) + 1e-9)
    return x


def labelled_sample(docs: DataFrame, labels: DataFrame, bound: int, doc_id: str, text: str) -> DataFrame:
    """About ``bound`` labelled documents at most: ``(y, text)``, chosen by a hash of the id.

    ``labels`` has columns ``doc_id`` and ``y``. The chosen ids, bounded by
    ``bound``, are broadcast. Rows that share an id are one example: of its
    texts, null being empty, that with the least digest; so however often an
    id repeats, ``bound`` holds for examples. Rows without an id are none.
    """
    n = labels.count()
    picked = labels
    if n > bound:
        picked = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * bound / n))
    picked = picked.select(F.col("doc_id").alias("_id"), "y").distinct()
    rows = (docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
            .join(F.broadcast(picked), "_id"))
    return rows.groupBy("_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("d"), "text"))["text"].alias("text")).select("y", "text")


def score_column(docs: DataFrame, cols: list[str], text: str, ddl: str, score: Callable,
                 max_bytes: int = 1 << 20) -> DataFrame:
    """``cols`` of ``docs`` and what ``score`` makes of the text column, batch by batch."""
    names = [x.split()[0] for x in ddl.split(",")]
    out = docs.select(*cols).schema
    for f in schema_of(ddl).fields:
        out = out.add(f)

    def run(batches: Iterator) -> Iterator:
        at = len(cols)
        for b in slices(batches, at, max_bytes):
            made = score(b.column(at))
            yield pa.RecordBatch.from_arrays([*b.columns[:at], *[pa.array(m) for m in made]], names=[*cols, *names])
    return docs.select(*cols, F.coalesce(F.col(text), F.lit("")).alias("_text")).mapInArrow(run, out)
