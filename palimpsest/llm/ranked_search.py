"""Operator 11: ranked lexical search by norm buckets of impact vectors, with exact integer scores."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from palimpsest.llm import hashed
from palimpsest.llm.common import cut_lineage, partitions_of, slices, with_workers

PART_CHARS = 32 << 20  # characters of items in one broadcast set; more items make more passes
BUCKET = 512  # vectors of similar length in a bucket, at most
CELLS = 1 << 20  # products of a vector's and an item's entries made at once, about
SLICE = 2 << 20  # bytes of text worked on at once
SLACK = 1 + 1e-9  # on bounds in doubles; scores are integers
NO_ID = (1 << 63) - 1  # stands for a null id: after all others


class Items:
    """The terms of a set of items: sorted term hashes, and each item's entries ``(item, term, count)`` sorted by both."""

    def __init__(self, ids: list, texts: list[str]):
        w = hashed.Words(pa.array(texts, pa.string()), hashed.MARKS)
        self.ids = ids
        self.terms, t = np.unique(w.hash, return_inverse=True)
        key, self.count = np.unique(w.row * max(len(self.terms), 1) + t, return_counts=True)
        self.item, self.term = key // max(len(self.terms), 1), key % max(len(self.terms), 1)
        self.length = np.sqrt(np.bincount(self.item, self.count.astype(float) ** 2, minlength=len(ids)))
        self.weight = np.zeros(len(self.terms), np.int64)
        self.n_docs = self.n_terms = 0

    def impacts(self, term: np.ndarray, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Weighted impacts of terms in documents of ``n`` terms, as integers."""
        m = 25 + (75 * n * self.n_docs) // max(self.n_terms, 1)
        return self.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


class Best:
    """The ``k`` best documents of each item so far (of equal scores those with the smaller ids), and what one must reach to be among them."""

    def __init__(self, n: int, k: int, least: np.ndarray):
        self.n, self.k, self.least = n, k, least.copy()
        self.item, self.doc, self.score = (np.empty(0, np.int64) for _ in range(3))

    def add(self, item: np.ndarray, doc: np.ndarray, score: np.ndarray) -> None:
        item, doc, score = (np.concatenate(x) for x in ((self.item, item), (self.doc, doc), (self.score, score)))
        order = np.lexsort((doc, -score, item))
        item, doc, score = item[order], doc[order], score[order]
        nth = np.arange(len(item)) - np.searchsorted(item, item)
        self.item, self.doc, self.score = (x[nth < self.k] for x in (item, doc, score))
        last = nth == self.k - 1
        self.least[item[last]] = np.maximum(self.least[item[last]], score[last])


def search_bucket(items: Items, best: Best, ids: np.ndarray, doc: np.ndarray, term: np.ndarray, y: np.ndarray, length: np.ndarray) -> int:
    """Rank a bucket of vectors (entries ``doc, term, y``, sorted; ``length`` per vector); returns how many pairs were scored exactly.

    1. An item whose length times the bucket's greatest cannot reach what the
       item needs is done with the bucket (Cauchy-Schwarz).
    2. No coordinate of a vector is above the bucket's greatest of its term.
       An item's terms with the smallest such bounds, as long as they cannot
       reach the need together, are left out: only vectors that hold one of
       its other terms are candidates.
    3. A candidate's sum over those other terms, plus the lesser of the
       coordinate bounds left out and their length times the vector's, must
       reach the need.
    4. What remains gets its exact score in integers, over all terms.
    """
    n_terms = len(items.terms)
    need = np.maximum(best.least, 1).astype(float)
    top = np.zeros(n_terms)
    np.maximum.at(top, term, y.astype(float))
    bound = items.count * top[items.term]
    total = np.bincount(items.item, bound, minlength=best.n)
    open_ = (items.length * length.max(initial=0.0) * SLACK >= need) & (total * SLACK >= need)
    entry = np.flatnonzero(open_[items.item] & (bound > 0))
    entry = entry[np.lexsort((bound[entry], items.item[entry]))]
    of = items.item[entry]
    if not len(entry):
        return 0
    run = np.cumsum(bound[entry])
    first = np.searchsorted(of, of)
    run -= np.append(0.0, run)[first]
    left = run * SLACK < need[of]
    rest = np.bincount(of[left], bound[entry][left], minlength=best.n)
    rest_length = np.sqrt(np.bincount(of[left], items.count[entry][left].astype(float) ** 2, minlength=best.n))
    wanted = entry[~left]
    wanted = wanted[np.argsort(items.term[wanted], kind="stable")]
    start = np.searchsorted(items.term[wanted], np.arange(n_terms + 1))
    n = (start[1:] - start[:-1])[term]
    ends = np.searchsorted(doc, np.arange(len(ids)), side="right")  # entries of each vector end here
    work = np.append(0, np.cumsum(n))[ends]
    keys = doc * n_terms + term
    item_start = np.searchsorted(items.item, np.arange(best.n + 1))
    lo, scored = 0, 0
    while lo < len(ids):
        done = work[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(work, done + CELLS, side="right")))
        part = slice(ends[lo - 1] if lo else 0, ends[hi - 1])
        lo = hi
        times = n[part]
        at = wanted[np.repeat(start[term[part]] - (np.cumsum(times) - times), times) + np.arange(times.sum())]
        pair, inverse = np.unique(np.repeat(doc[part], times) * best.n + items.item[at], return_inverse=True)
        got = np.bincount(inverse, items.count[at] * np.repeat(y[part], times).astype(float), minlength=len(pair))
        d, i = pair // best.n, pair % best.n
        may = (got + np.minimum(rest[i], rest_length[i] * length[d])) * SLACK >= need[i]
        d, i = d[may], i[may]
        if not len(d):
            continue
        scored += len(d)
        size = item_start[i + 1] - item_start[i]
        begin = np.cumsum(size) - size
        e = np.repeat(item_start[i] - begin, size) + np.arange(size.sum())
        want = np.repeat(d, size) * n_terms + items.term[e]
        place = np.searchsorted(keys, want).clip(max=len(keys) - 1)
        score = np.add.reduceat(np.where(keys[place] == want, y[place] * items.count[e], 0), begin)
        enough = (score > 0) & (score >= best.least[i])
        best.add(i[enough], ids[d[enough]], score[enough])
    return scored


def _vectors(docs: DataFrame, shared, doc_id: str, text: str) -> DataFrame:
    """``id, n, term, tf``: number of terms of each row and, as packed integers, its items' terms with their counts."""
    def run(batches: Iterator) -> Iterator:
        items = shared.value
        for b in slices(batches, 1, SLICE):
            w = hashed.Words(b.column(1), hashed.MARKS)
            at = np.searchsorted(items.terms, w.hash).clip(max=max(len(items.terms) - 1, 0))
            hit = items.terms[at] == w.hash if len(items.terms) else np.zeros(len(w.hash), bool)
            key, tf = np.unique(w.row[hit] * max(len(items.terms), 1) + at[hit], return_counts=True)
            row, term = key // max(len(items.terms), 1), (key % max(len(items.terms), 1)).astype(np.int32)
            cuts = np.searchsorted(row, np.arange(b.num_rows + 1))
            pack = lambda x: pa.array([x[i:j].tobytes() for i, j in zip(cuts, cuts[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(w.counts()), pack(term), pack(tf.astype(np.int32))], names=["id", "n", "term", "tf"])
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return rows.mapInArrow(run, "id long, n long, term binary, tf binary")


def _entries(b: pa.RecordBatch, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, term, y)`` of a batch of vectors (columns ``id, n, term, tf``)."""
    data, offsets = hashed.bytes_of(b.column(2))
    row = np.repeat(np.arange(b.num_rows), np.diff(offsets) // 4)
    term = data.view(np.int32).astype(np.int64)
    tf = hashed.bytes_of(b.column(3))[0].view(np.int32).astype(np.int64)
    return row, term, items.impacts(term, tf, b.column(1).to_numpy()[row])


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text",
                   item_id: str = "item_id", item_text: str = "text", part_chars: int = PART_CHARS) -> DataFrame:
    """The ``k`` highest-scoring documents of each item: ``item_id, rank, doc_id, score``.

    Terms are runs of ASCII letters, digits and other letters, A-Z
    lower-cased, compared by 64-bit hashes. Weights and lengths are of all
    documents with a term; scores are sums of integers (see ``Items.impacts``).
    Equal scores rank by ascending id, a null id last. Null, empty and
    termless texts match nothing; repeated rows are documents of their own;
    items equal in id and text count once, items of one id with different
    texts are ranked apart; no documents or items give no rows.

    1. Each text becomes a vector of the items' terms it holds, written once.
       Document counts of terms come from the vectors.
    2. Impact vectors are sorted by length into ranges over all documents,
       the longest first. The first range is searched alone; the ``k``-th
       score of each item there is what any other document has to reach.
    3. All ranges are searched bucket by bucket (``search_bucket``), and what
       a task finds raises what its later buckets have to reach. At most ``k``
       documents an item leave a task and are ranked.
    """
    spark = with_workers(docs.sparkSession)
    kind, id_kind = items.schema[item_id].dataType.simpleString(), docs.schema[doc_id].dataType.simpleString()
    clean = (items.select(F.col(item_id).alias("i"), F.col(item_text).alias("t"))
             .where(F.col("t").rlike(r"[0-9A-Za-z\x{80}-\x{10FFFF}]")).distinct())
    total = clean.agg(F.count("*").alias("n"), F.sum(F.length("t")).alias("chars")).first()
    found = None
    parts = max(1, -(-(total["chars"] or 0) // part_chars)) if total["n"] else 0
    for part in range(parts):
        rows = clean.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == part).collect()  # part_chars of items, about
        if rows:
            rows.sort(key=lambda r: (str(r["i"]), r["t"]))
            some = _rank_part(docs, Items([r["i"] for r in rows], [r["t"] for r in rows]), k, doc_id, text, kind)
            found = some if found is None or some is None else found.union(some)
    if found is None:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id {id_kind}, score long")
    return found.select("item_id", "rank", F.when(F.col("doc") != NO_ID, F.col("doc")).cast(id_kind).alias("doc_id"), "score")


def _rank_part(docs: DataFrame, items: Items, k: int, doc_id: str, text: str, kind: str) -> DataFrame:
    spark = docs.sparkSession
    vectors = cut_lineage(_vectors(docs, spark.sparkContext.broadcast(items), doc_id, text))

    def frequencies(batches: Iterator) -> Iterator:
        df = np.zeros(len(items.terms), np.int64)
        for b in batches:
            df += np.bincount(hashed.bytes_of(b.column(0))[0].view(np.int32), minlength=len(df))
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["term", "df"])
    size = vectors.where("n > 0").agg(F.count("*").alias("N"), F.sum("n").alias("L")).first()
    items.n_docs, items.n_terms = size["N"], size["L"] or 0
    for r in vectors.select("term").mapInArrow(frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        items.weight[r["term"]] = math.floor(1000 * math.log((2 * size["N"] + 2) / (2 * r["df"] + 1)))
    shared = spark.sparkContext.broadcast(items)  # part_chars of items

    def lengths(batches: Iterator) -> Iterator:
        for b in batches:
            row, _, y = _entries(b, shared.value)
            length = np.sqrt(np.bincount(row, y.astype(float) ** 2, minlength=b.num_rows))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(length)], names=["id", "n", "term", "tf", "length"])
    # the id and a running number deal out vectors of one length, such as copies
    ordered = (vectors.where(F.octet_length("term") > 0).mapInArrow(lengths, "id long, n long, term binary, tf binary, length double")
               .withColumn("nth", F.monotonically_increasing_id())
               .repartitionByRange(partitions_of(spark), F.col("length").desc(), "id", "nth")
               .sortWithinPartitions(F.col("length").desc(), "id", "nth").drop("nth"))
    ordered = cut_lineage(ordered).withColumn("part", F.spark_partition_id())

    def search(least: np.ndarray):
        def run(batches: Iterator) -> Iterator:
            it = shared.value
            best = Best(len(it.ids), k, least)
            for batch in batches:
                for lo in range(0, batch.num_rows, BUCKET):
                    b = batch.slice(lo, BUCKET)
                    search_bucket(it, best, b.column(0).to_numpy(), *_entries(b, it), b.column(4).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(best.item), pa.array([it.ids[i] for i in best.item], None if len(best.item) else pa.null()).cast(id_type),
                                              pa.array(best.doc), pa.array(best.score)], names=["item", "item_id", "doc", "score"])
        return run
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string
    id_type = to_arrow_type(_parse_datatype_string(kind))
    ddl = f"item long, item_id {kind}, doc long, score long"
    nothing = np.zeros(len(items.ids), np.int64)
    first = ordered.where("part = 0").drop("part").mapInArrow(search(nothing), ddl)
    least = nothing.copy()
    for r in first.groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= k).collect():
        least[r["item"]] = r["least"]
    each = W.partitionBy("item").orderBy(F.col("score").desc(), "doc")
    return (ordered.drop("part").mapInArrow(search(least), ddl).withColumn("rank", F.row_number().over(each)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc", "score"))


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS t
           FROM documents),
s AS (SELECT CAST(count(*) AS BIGINT) AS N, CAST(sum(len(t)) AS BIGINT) AS L FROM d WHERE len(t) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY ALL),
i AS (SELECT row_number() OVER () AS k, item_id,
             regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS t
      FROM (SELECT DISTINCT item_id, text FROM benchmark)),
q AS (SELECT k, term, count(*) AS c FROM (SELECT k, unnest(t) AS term FROM i) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * N + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY term, N),
x AS (SELECT q.k, tf.r, CAST(sum(q.c * w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (25 + (75 * len(d.t) * s.N) // s.L)))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN tf USING (term) JOIN d USING (r), s GROUP BY q.k, tf.r),
y AS (SELECT i.item_id, d.doc_id, x.score, CAST(row_number() OVER (PARTITION BY x.k ORDER BY x.score DESC, d.doc_id) AS INTEGER) AS rank
      FROM x JOIN i USING (k) JOIN d USING (r) WHERE x.score > 0)
SELECT item_id, rank, doc_id, score FROM y WHERE rank <= 10
"""
