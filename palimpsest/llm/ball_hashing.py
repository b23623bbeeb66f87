"""Operator 13: near copies by SimHash fingerprints that meet in the middle of a Hamming radius."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from palimpsest.llm import hashed
from palimpsest.llm.common import cut_lineage, min_labels, slices, with_workers

BITS = 64
SEED = 42
NO_ID = -(1 << 63)  # stands for a null id
PART = 1 << 21  # variants that meet in one part, about
SLICE = 1 << 20  # bytes of text worked on at once


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def shingle_bytes(col: pa.Array, k: int) -> tuple[np.ndarray, list[int], list[int], bytes]:
    """``(row, start, end, text)``: each run of ``k`` words of a row (all its words, if fewer), joined by one space, is text[start:end]."""
    w = hashed.Words(col)
    n = len(w.start)
    text, keep = w.data.copy(), np.zeros(len(w.data), bool)
    more = np.flatnonzero(w.row[1:] == w.row[:-1]) if n else np.empty(0, np.int64)  # words with another after them
    text[w.end[more]] = 0x20
    edge = np.zeros(len(w.data) + 1, np.int64)
    np.add.at(edge, w.start, 1)
    np.add.at(edge, w.end, -1)
    keep |= np.cumsum(edge)[:-1] > 0
    keep[w.end[more]] = True
    place = np.cumsum(keep) - 1
    start = place[w.start]
    end = start + (w.end - w.start)
    counts = w.counts()
    full = np.flatnonzero(w.row[:n - k + 1] == w.row[k - 1:]) if n >= k else np.empty(0, np.int64)
    few = np.flatnonzero((counts > 0) & (counts < k))
    head = np.searchsorted(w.row, few)
    row = np.concatenate((w.row[full], few))
    a, z = np.concatenate((start[full], start[head])), np.concatenate((end[full + k - 1], end[head + counts[few] - 1]))
    order = np.argsort(row, kind="stable")
    return row[order], a[order].tolist(), z[order].tolist(), text[keep].tobytes()


def fingerprints_of(col: pa.Array, k: int = 4) -> np.ndarray:
    """The 64-bit fingerprint of each row: a bit is 1 if set in over half the XXH64 of its shingles (repeats included)."""
    row, a, z, text = shingle_bytes(col, k)
    out = np.zeros(len(col), np.uint64)
    if len(row):
        h = np.fromiter((xxh64_intdigest(text[i:j], SEED) for i, j in zip(a, z)), np.uint64, len(a))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        begin = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        votes = np.add.reduceat(bits, begin, axis=0, dtype=np.int64)
        size = np.diff(np.append(begin, len(row)))
        out[row[begin]] = np.packbits(2 * votes > size[:, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprint_rows(docs: DataFrame, k: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, fingerprint`` (longs) of every whole text; null and wordless texts have fingerprint 0, a null id is ``NO_ID``."""
    with_workers(docs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        for b in slices(batches, 1, SLICE):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fingerprints_of(b.column(1), k).view(np.int64))], names=["id", "fingerprint"])
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return rows.mapInArrow(run, "id long, fingerprint long")


def ball(half: int) -> np.ndarray:
    """Masks of up to ``half`` set bits."""
    return np.array([sum(1 << i for i in c) for n in range(half + 1) for c in combinations(range(BITS), n)], np.uint64)


def _groups(bits: int) -> list[int]:
    return [sum(1 << i for i in range(g, BITS, bits)) for g in range(bits)]


def fold(x: np.ndarray, bits: int) -> np.ndarray:
    """Parities of ``bits`` groups of bits (every ``bits``-th one): a linear map, so fold(x ^ m) = fold(x) ^ fold(m)."""
    out = np.zeros(len(x), np.int64)
    for g, mask in enumerate(_groups(bits)):
        out |= (np.bitwise_count(x & np.uint64(mask)) & 1).astype(np.int64) << g
    return out


def fold_column(x: Column, bits: int) -> Column:
    out = F.lit(0).cast("long")
    for g, mask in enumerate(_groups(bits)):
        out = out.bitwiseOR(F.shiftleft(F.bit_count(x.bitwiseAND(F.lit(signed(mask)))).bitwiseAND(F.lit(1)).cast("long"), g))
    return out


def meetings(prints: np.ndarray, part: int, bits: int, half: int, radius: int, most: int = 2 * PART) -> np.ndarray:
    """Links among ``prints`` (distinct) by the variants that lie in ``part``, as pairs of a fingerprint and a smaller one.

    Two fingerprints with a variant in common are at most ``radius`` bits
    apart; each is held against the smallest of its variant, whose distance is
    checked, and what hangs together comes out as a forest. Variants are made
    in turns of about ``most``.
    """
    masks = ball(half)
    shift = fold(masks, bits)
    by_shift = {int(s): masks[shift == s] for s in np.unique(shift)}
    away = fold(prints, bits) ^ part
    turns = max(1, -(-int(sum((away == s).sum() * len(m) for s, m in by_shift.items())) // most))
    links = np.empty((0, 2), np.int64)
    for turn in range(turns):
        variants, of = [], []
        for s, m in by_shift.items():
            every = np.flatnonzero(away == s)
            for lo in range(0, len(every), step := 1 + most // len(m)):
                mine = every[lo:lo + step]
                v = (prints[mine][:, None] ^ m[None, :]).ravel()
                at = np.repeat(mine, len(m))
                if turns > 1:
                    now = hashed.mix(v) % np.uint64(turns) == turn
                    v, at = v[now], at[now]
                variants.append(v)
                of.append(at)
        if not variants:
            break
        v, at = np.concatenate(variants), np.concatenate(of)
        order = np.argsort(v)
        v, at = v[order], at[order]
        same = np.append(False, v[1:] == v[:-1])
        run = np.flatnonzero(same | np.append(same[1:], False))  # variants of more than one fingerprint
        if not len(run):
            continue
        begin = np.flatnonzero(~same[run])
        own = prints.view(np.int64)[at[run]]
        least = np.repeat(np.minimum.reduceat(own, begin), np.diff(np.append(begin, len(run))))
        pairs = np.unique(np.stack((own, least), axis=1)[own != least], axis=0)
        close = np.bitwise_count((pairs[:, 0] ^ pairs[:, 1]).view(np.uint64)) <= radius
        links = forest(np.concatenate((links, pairs[close])))
    return links


def forest(pairs: np.ndarray) -> np.ndarray:
    """For each value in ``pairs`` but the smallest of its component: itself and that smallest."""
    names, at = np.unique(pairs, return_inverse=True)
    a, b = at.reshape(-1, 2).T if len(pairs) else (at, at)
    root = np.arange(len(names))
    while True:
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, root[a])
        np.minimum.at(new, root, new.copy())  # a root learns what its members found
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    child = np.flatnonzero(root != np.arange(len(names)))
    return np.stack((names[child], names[root[child]]), axis=1)


def links_within(prints: DataFrame, radius: int = 4) -> DataFrame:
    """Links ``a, b`` whose components are those of all fingerprints at most ``radius`` (even) bits apart.

    ``prints`` has a column ``fingerprint`` (long); copies are one. Every
    fingerprint stands for all its variants within half the radius: two that
    are near enough have one in common, and two that have one are near enough.
    Variants are shuffled by their fold (``fold``), whose number of bits grows
    with the number of fingerprints, so that a part holds about ``PART`` of
    them. Variants of one fingerprint that go to one part are sent as the
    fingerprint, once, and made there: 1 + b + b (b - 1) / 2 rows at b bits
    instead of 2081. Fingerprints that differ in a few bits have other folds,
    so that a large group of near copies spreads over the parts too, and no
    variant belongs to more than 2081 of them.
    """
    if radius % 2 or radius > 4:
        raise ValueError("the radius must be 0, 2 or 4")
    half = radius // 2
    once = cut_lineage(prints.select("fingerprint").where("fingerprint IS NOT NULL").distinct())
    size = len(ball(half))
    bits = min(32, max(0, -(-once.count() * size // PART) - 1).bit_length())
    near = sorted({sum(1 << i for i in c) for n in range(half + 1) for c in combinations(range(bits), n)})
    routes = (once.withColumn("fold", fold_column(F.col("fingerprint"), bits))
              .select("fingerprint", "fold", F.explode(F.array(*[F.lit(s).cast("long") for s in near])).alias("step"))
              .select("fingerprint", F.col("fold").bitwiseXOR(F.col("step")).alias("part")))

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        found = meetings(pdf["fingerprint"].to_numpy().view(np.uint64), int(pdf["part"].iloc[0]), bits, half, radius)
        return pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})
    return routes.groupBy("part").applyInPandas(meet, "a long, b long")


def near_copies(docs: DataFrame, radius: int = 4, k: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row of ``docs``.

    Fingerprints are made of the ``k``-word shingles of the whole text (A-Z
    lower-cased, words without ASCII white space, joined by one space; fewer
    words are one shingle); those at most ``radius`` bits apart are linked.
    ``component_id`` is the smallest id reachable by links, the row's own
    included. Null, empty and wordless texts have fingerprint zero and are
    linked like any other; a null id is below all others; repeated rows and
    rows that repeat an id are rows of their own; no rows give no rows.
    """
    rows = cut_lineage(fingerprint_rows(docs, k, doc_id, text))  # 16 bytes a document
    labels = min_labels(docs.sparkSession, links_within(rows, radius))
    lows = rows.groupBy("fingerprint").agg(F.min("id").alias("low"))
    member = lows.join(labels.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn("label", F.coalesce("label", "fingerprint"))
    least = member.groupBy("label").agg(F.min("low").alias("least"))
    member = member.join(least, "label").select("fingerprint", "least")
    real = lambda c: F.when(c != NO_ID, c)
    return (rows.join(member, "fingerprint")
            .select(real(F.col("id")).alias("doc_id"), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
                    real(F.col("least")).alias("component_id")))
