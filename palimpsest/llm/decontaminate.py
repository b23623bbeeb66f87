"""Operator 4: benchmark decontamination by BM25 with block-max pruning, then question and answer overlap."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm import hashed
from palimpsest.llm.common import slices, with_workers

K1, B = 1.2, 0.75
RETRIEVE = 0.6  # share of an item's own BM25 score that a passage must reach
OVERLAP = 0.6  # share of the question's and of the answer's word pairs that the passage must hold
# Items in a block of the index. Bounds of larger blocks join the weights of several items: on 200 items and
# 4.8 MB of text, blocks of 1, 2 and 3 items took 0.45, 1.17 and 2.02 s, and blocks of 16 pruned nothing.
BLOCK = 1
PART_CHARS = 32 << 20  # characters of test items in one broadcast index; more items make more passes


def sides(text: str) -> tuple[str, str]:
    """Question and answer of a test item: its last line or sentence is the answer, the last quarter of words if it has one only."""
    import re
    parts = [p for p in re.split(r"(?<=[.?!])\s+|\n", text) if re.search(r"\w", p)]
    if len(parts) > 1:
        return " ".join(parts[:-1]), parts[-1]
    words = text.split()
    cut = max(1, len(words) - max(1, len(words) // 4))
    return " ".join(words[:cut]), " ".join(words[cut:])


def pair_hashes(h: np.ndarray) -> np.ndarray:
    """Hashes of neighbouring word pairs (of the word, if there is one only)."""
    return hashed.mix(h[:-1] * hashed._BASE + h[1:]) if len(h) > 1 else hashed.mix(h + np.uint64(1))


def word_list(text: str) -> np.ndarray:
    return hashed.Words(pa.array([text], pa.string()), hashed.MARKS).hash


class Index:
    """Inverted index of the test items of one length class, in blocks of ``BLOCK`` items.

    ``cell`` is the longest item's length in words: passages are windows of
    two cells, one cell apart, so each run of ``cell`` words lies in one.
    """

    def __init__(self, items: list[dict], n_items: int, mean_len: float, retrieve: float):
        self.ids = [x["item_id"] for x in items]
        self.cell = max(len(x["words"]) for x in items)
        self.question = [np.unique(pair_hashes(x["question"])) for x in items]
        self.answer = [np.unique(pair_hashes(x["answer"])) for x in items]
        term, item, weight = [], [], []
        for i, x in enumerate(items):
            t, at, tf = np.unique(x["words"], return_index=True, return_counts=True)
            idf = np.log(1 + (n_items - x["df"][at] + 0.5) / (x["df"][at] + 0.5))
            term.append(t)
            item.append(np.full(len(t), i))
            weight.append(idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(x["words"]) / mean_len)))
        term, item, weight = map(np.concatenate, (term, item, weight))
        self.own = np.bincount(item, weight, minlength=len(items))
        self.least = retrieve * self.own
        self.terms, t = np.unique(term, return_inverse=True)
        order = np.lexsort((t, item))
        self.item_start = np.searchsorted(item[order], np.arange(len(items) + 1))
        self.item_term, self.item_weight = t[order], weight[order]
        # block maxima, and each block's lists without its weakest terms, which together reach half the threshold at most
        n_blocks = (len(items) - 1) // BLOCK + 1
        block_least = np.array([self.least[b * BLOCK:(b + 1) * BLOCK].min() for b in range(n_blocks)])
        key, inverse = np.unique(item // BLOCK * len(self.terms) + t, return_inverse=True)
        top = np.zeros(len(key))
        np.maximum.at(top, inverse, weight)
        block, t = key // len(self.terms), key % len(self.terms)
        order = np.lexsort((top, block))
        block, t, top = block[order], t[order], top[order]
        run = np.cumsum(top)
        run -= np.concatenate(([0.0], run))[np.searchsorted(block, block)]
        weak = run <= 0.5 * block_least[block]
        self.needed = block_least - np.bincount(block[weak], top[weak], minlength=n_blocks) - 1e-9
        block, t, top = block[~weak], t[~weak], top[~weak]
        order = np.argsort(t, kind="stable")
        self.block, self.top = block[order], top[order]
        self.start = np.searchsorted(t[order], np.arange(len(self.terms) + 1))

    def hits(self, w: hashed.Words, term_at: np.ndarray) -> Iterator[tuple[int, int, int, float, float, float]]:
        """``(row, item number, first word, score / own score, question share, answer share)`` of passages retrieved."""
        counts = w.counts()
        first = np.cumsum(counts) - counts
        cells = np.maximum(1, -(-counts // self.cell))
        base = np.cumsum(cells) - cells
        known = np.flatnonzero(term_at >= 0)
        strong = known[self.start[term_at[known] + 1] > self.start[term_at[known]]]
        cell = (np.arange(len(w.hash)) - first[w.row]) // self.cell
        # window c of a row has the words of its cells c and c + 1
        here = strong[(cell[strong] == 0) | (cell[strong] < cells[w.row[strong]] - 1)]
        before = strong[cell[strong] > 0]
        window = np.concatenate((base[w.row[here]] + cell[here], base[w.row[before]] + cell[before] - 1))
        pairs = np.unique(window * len(self.terms) + term_at[np.concatenate((here, before))])
        window, t = pairs // len(self.terms), pairs % len(self.terms)
        n = self.start[t + 1] - self.start[t]
        at = np.repeat(self.start[t] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        n_blocks = len(self.needed)
        key, inverse = np.unique(np.repeat(window, n) * n_blocks + self.block[at], return_inverse=True)
        bound = np.bincount(inverse, self.top[at], minlength=len(key))
        for k in key[bound >= self.needed[key % n_blocks]]:
            window, block = divmod(int(k), n_blocks)
            row = int(np.searchsorted(base, window, side="right") - 1)
            lo = first[row] + (window - base[row]) * self.cell
            hi = min(lo + 2 * self.cell, first[row] + counts[row])
            have = np.unique(term_at[lo:hi])
            pairs_here = None
            for i in range(block * BLOCK, min(len(self.ids), (block + 1) * BLOCK)):
                a, z = self.item_start[i], self.item_start[i + 1]
                score = self.item_weight[a:z][np.isin(self.item_term[a:z], have)].sum()
                if score < self.least[i] or not self.own[i]:
                    continue
                if pairs_here is None:
                    h = w.hash[lo:hi]
                    pairs_here = np.concatenate((pair_hashes(h), hashed.mix(h + np.uint64(1))))
                yield (row, i, int(lo - first[row]), score / self.own[i],
                       np.isin(self.question[i], pairs_here).mean(), np.isin(self.answer[i], pairs_here).mean())


def build_indexes(items: DataFrame, retrieve: float = RETRIEVE, part_chars: int = PART_CHARS) -> Iterator[list[Index]]:
    """Indexes of the test items, part by part: each list holds about ``part_chars`` characters of items at most.

    Document frequencies and the mean length are of all items in every part.
    Items of one part reach the driver together, never more.
    """
    with_workers(items.sparkSession)
    clean = items.select("item_id", F.col("text").alias("t")).where(F.col("t").rlike(r"[A-Za-z0-9\x{80}-\x{10FFFF}]")).distinct()

    def words(batches: Iterator) -> Iterator:
        for b in slices(batches, 1):
            w = hashed.Words(b.column(1), hashed.MARKS)
            pairs = np.unique(np.stack((w.row, w.hash.astype(np.int64))), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[1])], names=["term"])
    total = clean.agg(F.count("*").alias("n"), F.sum(F.length("t")).alias("chars")).first()
    if not total["n"]:
        return
    parts = max(1, -(-total["chars"] // part_chars))
    df = clean.mapInArrow(words, "term long").groupBy("term").agg(F.count("*").alias("df"))
    size = clean.select(F.avg(F.regexp_count("t", F.lit(r"[A-Za-z0-9\x{80}-\x{10FFFF}]+")))).first()[0]
    numbered = clean.withColumn("part", F.pmod(F.xxhash64("item_id", "t"), F.lit(parts)))

    def own_terms(batches: Iterator) -> Iterator:
        for b in slices(batches, 2):
            w = hashed.Words(b.column(2), hashed.MARKS)
            t = np.unique(w.hash.astype(np.int64))
            part = b.column(0)[0].as_py()
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(t), pa.int64()), pa.array(t)], names=["part", "term"])
    for part in range(parts):
        mine = numbered.where(F.col("part") == part).select("part", "item_id", "t")
        rows = sorted(mine.select("item_id", "t").collect(), key=lambda r: (str(r[0]), r[1]))
        if not rows:
            continue
        got = mine.mapInArrow(own_terms, "part long, term long").select("term").distinct().join(df, "term").toPandas()
        keys = got["term"].to_numpy().astype(np.uint64)
        order = np.argsort(keys)
        keys, freq = keys[order], got["df"].to_numpy()[order]
        classes: dict[int, list[dict]] = {}
        for r in rows:
            h = word_list(r["t"])
            q, a = sides(r["t"])
            q, a = word_list(q), word_list(a)
            x = {"item_id": r["item_id"], "words": h, "df": freq[np.searchsorted(keys, h)], "question": q if len(q) else h, "answer": a if len(a) else h}
            classes.setdefault(max(6, int(len(h) - 1).bit_length()), []).append(x)
        yield [Index(sorted(x, key=lambda i: len(i["words"])), total["n"], size, retrieve) for _, x in sorted(classes.items())]


def leaks_of(col: pa.Array, indexes: list[Index], overlap: float) -> dict[tuple[int, int, int], tuple]:
    """For each (row, index, item) of a text column that leaks: its best passage."""
    w = hashed.Words(col, hashed.MARKS)
    best: dict[tuple[int, int, int], tuple] = {}
    for k, index in enumerate(indexes):
        at = np.searchsorted(index.terms, w.hash).clip(max=len(index.terms) - 1)
        term_at = np.where(index.terms[at] == w.hash, at, -1)
        for row, item, word, score, q, a in index.hits(w, term_at):
            if q >= overlap and a >= overlap:
                best[row, k, item] = max(best.get((row, k, item), ()), (score, q, a, -word))
    return best


def find_leaks(docs: DataFrame, items: DataFrame, retrieve: float = RETRIEVE, overlap: float = OVERLAP,
               doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents that hold test items: ``doc_id, item_id, word, score, question_overlap, answer_overlap``.

    Each document's passages (windows over its whole text) query a BM25 index
    of the items. An item is retrieved if a passage reaches ``retrieve`` of the
    item's own score; blocks of items whose summed block maxima cannot reach it
    are never opened. A retrieved item is a leak if the passage holds ``overlap``
    of the word pairs of both its question and its answer. One row per row of
    ``docs`` and leaked item, with the best passage's first word and figures.

    Null and empty texts hold nothing, items without a word are never found,
    repeated rows are judged one by one, repeated equal items count once.
    """
    spark = with_workers(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    kind = items.schema["item_id"].dataType
    ddl = f"item_id {kind.simpleString()}, word long, score double, question_overlap double, answer_overlap double"
    found = None
    for indexes in build_indexes(items, retrieve):
        shared = spark.sparkContext.broadcast(indexes)  # PART_CHARS of items at most

        def run(batches: Iterator, shared=shared) -> Iterator:
            for b in slices(batches, 1):
                best = sorted(leaks_of(b.column(1), shared.value, overlap).items())
                r = pa.array([k[0] for k, _ in best], pa.int64())
                cols = list(zip(*[(shared.value[k[1]].ids[k[2]], -v[3], v[0], v[1], v[2]) for k, v in best])) or [()] * 5
                yield pa.RecordBatch.from_arrays([b.column(0).take(r), *[pa.array(c, t) for c, t in zip(
                    cols, (None if best else pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()))]],
                    names=["doc_id", "item_id", "word", "score", "question_overlap", "answer_overlap"])
        some = rows.mapInArrow(run, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, {ddl}")
        found = some if found is None else found.union(some)
    return found if found is not None else spark.createDataFrame([], f"doc_id {docs.schema[doc_id].dataType.simpleString()}, {ddl}")


def drop_leaks(docs: DataFrame, items: DataFrame, retrieve: float = RETRIEVE, overlap: float = OVERLAP) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with the same columns; no row is shuffled."""
    spark = with_workers(docs.sparkSession)
    at = docs.columns.index("text")
    for indexes in build_indexes(items, retrieve):
        shared = spark.sparkContext.broadcast(indexes)

        def run(batches: Iterator, shared=shared) -> Iterator:
            for b in slices(batches, at):
                keep = np.ones(b.num_rows, bool)
                keep[[k[0] for k in leaks_of(b.column(at), shared.value, overlap)]] = False
                yield b.filter(pa.array(keep))
        docs = docs.mapInArrow(run, docs.schema)
    return docs
