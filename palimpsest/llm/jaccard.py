"""Operator 8: n-gram Jaccard self-join by a token-group matrix, up to connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palimpsest.llm import hashed
from palimpsest.llm.common import WORD, Sieve, cut_lineage, free_name, min_labels, shuffles_go, slices, with_workers

GROUP = 64  # texts in a group of the matrix, about
BUNDLE = 1 << 21  # bytes of tokens in a bundle of groups, about
CELLS = 1 << 20  # pairs of texts that a task holds links of at once, about
NO_ID = -(1 << 63)  # stands for a null id


def token_sets(col: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, token, cuts)``: each row's distinct k-word shingles, ascending by hash; row i has tokens[cuts[i]:cuts[i + 1]]."""
    row, h = hashed.shingles(hashed.Words(col), k)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    row, h = row[first], h[first]
    return row, h, np.searchsorted(row, np.arange(len(col) + 1))


def set_digests(row: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit digest of each row's set: a mixed sum of its mixed tokens and its size."""
    total = np.zeros(n, np.uint64)
    np.add.at(total, row, hashed.mix(h ^ np.uint64(0x5851F42D4C957F2D)))
    return hashed.mix(total + np.bincount(row, minlength=n).astype(np.uint64)).astype(np.int64)


def needed(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Shared tokens that a set of ``n`` needs with any set that it links to."""
    return (percent * n + 99) // 100


def linked(sets: list[np.ndarray], left: int, percent: int) -> np.ndarray:
    """Smallest member of each set's component, by links of the first ``left`` sets with the others (``left`` 0: among all).

    Works in blocks of about ``CELLS`` pairs, counts and links alike; links go on as one forest, however many there are.
    """
    n = np.array([len(s) for s in sets])
    every = np.concatenate(sets)
    of = np.repeat(np.arange(len(sets)), n)
    split = left or len(sets)
    names, code = np.unique(every, return_inverse=True)
    # only names that both sides hold can be shared: the others need no column
    there = np.bincount(code[of >= left], minlength=len(names))
    both = (np.bincount(code[of < left], minlength=len(names)) > 0) & (there > 0) if left else there > 1
    column = np.cumsum(both) - 1
    used = both[code]
    of, code, width = of[used], column[code[used]], int(both.sum())
    others = len(sets) - left
    right = of >= left
    of_right, code_right = of[right] - left, code[right]
    step = max(256, 2 * CELLS // len(sets))
    forest = np.empty((0, 2), np.int64)
    rows = max(1, CELLS // others)
    for lo in range(0, split, rows):
        hi = min(lo + rows, split)
        mine = slice(*np.searchsorted(of, (lo, hi)))
        names, at = np.unique(code[mine], return_inverse=True)  # the columns that these rows hold
        place = np.full(width, -1)
        place[names] = np.arange(len(names))
        at_right = place[code_right]
        common = np.zeros((hi - lo, others), np.float32)
        for c in range(0, len(names), step):
            wide = min(step, len(names) - c)
            here = (at >= c) & (at < c + step)
            a = np.zeros((hi - lo, wide), np.float32)
            a[of[mine][here] - lo, at[here] - c] = 1
            b = a
            if left or hi - lo < others:
                there = (at_right >= c) & (at_right < c + step)
                b = np.zeros((others, wide), np.float32)
                b[of_right[there], at_right[there] - c] = 1
            common += a @ b.T
        common = common.astype(np.float64)
        i, j = np.nonzero(100 * common >= percent * (n[lo:hi, None] + n[None, left:] - common))
        i, j = i + lo, j + left
        links = np.stack((i, j), axis=1)[i < j]
        if len(links):
            root = roots(len(sets), np.concatenate((forest, links)))
            child = np.flatnonzero(root != np.arange(len(sets)))
            forest = np.stack((root[child], child), axis=1)
    return roots(len(sets), forest)


def roots(n: int, pairs: np.ndarray) -> np.ndarray:
    """Smallest member of each node's component."""
    root = np.arange(n)
    for _ in range(n):
        new = root.copy()
        np.minimum.at(new, pairs[:, 0], root[pairs[:, 1]])
        np.minimum.at(new, pairs[:, 1], root[pairs[:, 0]])
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    return root


def jaccard_components(docs: DataFrame, k: int = 4, percent: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Link documents whose sets of k-word shingles have a Jaccard likeness of ``percent`` / 100 or more.

    Words are runs without ASCII white space, A-Z lower-cased; a text of fewer
    than ``k`` words is one shingle, one without words or null has the empty
    set and links with nothing. Returns ``doc_id, n_shingles, component_id``
    (smallest id reachable by links), one row per row of ``docs``. A null id
    is below all others. Shingles are compared by 64-bit hashes.

    1. Equal sets are one class. Each class names the smallest hashes of its
       set, one and a half times the prefix that a linked pair must share a token of. Tokens
       of one class only are dropped; a class with more of them than a linked
       one can have is done, and most are. Those left are counted by whole sets: tokens
       that no other of them holds are dropped, classes with less than a link
       needs are done, and the rest keep their rarest tokens, as many as
       their prefix has left.
    2. Those left are partitioned into groups of likely similar texts: those
       with the same smallest hash, dealt into groups of about ``GROUP``.
       Each group is linked inside; where one hash value fills several groups,
       representatives of what linked meet again as long as that shrinks.
    3. The token-group matrix has, for each kept token, the groups that hold
       it, unless all holders are in one component already. Groups that hang
       together by tokens are bundled up to about ``BUNDLE`` bytes; two bundles
       that share a token are a candidate. A text is compared with the other
       bundle's token union first, and only bundles with texts that can qualify
       are opened.
    """
    rows = _labelled(docs, k, percent, doc_id, text)
    low = rows.where("label IS NOT NULL").groupBy("label").agg(F.min("id").alias("low"))
    real = lambda x: F.when(x != NO_ID, x)
    return (rows.join(low, "label", "left")
            .select(real(F.col("id")).alias("doc_id"), F.col("n").alias("n_shingles"), real(F.coalesce("low", "id")).alias("component_id")))


def _labelled(docs: DataFrame, k: int, percent: int, doc_id: str, text: str) -> DataFrame:
    """``id, n, c, t, label`` for each row: its set's size and digest, its text's digest and its component (null for an empty set)."""
    with shuffles_go(with_workers(docs.sparkSession)) as spark:
        return _linked_rows(spark, docs, k, percent, doc_id, text)


def _linked_rows(spark: SparkSession, docs: DataFrame, k: int, percent: int, doc_id: str, text: str) -> DataFrame:
    d = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    d = d.withColumn("t", F.xxhash64("text"))

    def digests(batches: Iterator) -> Iterator:
        for b in slices(batches, 1):
            row, h, cuts = token_sets(b.column(1), k)
            n = np.diff(cuts)
            c = set_digests(row, h, b.num_rows)
            # one row a class of the batch, the one with the smallest id, names the smallest hashes
            order = np.lexsort((b.column(0).to_numpy(), c))
            order = order[n[order] > 0]
            once = np.ones(len(order), bool)
            once[1:] = c[order[1:]] != c[order[:-1]]
            most = np.zeros(b.num_rows, np.int64)
            most[order[once]] = np.minimum(n, (3 * (n - needed(n, percent) + 1) + 1) // 2)[order[once]]
            smallest = pa.array([h[a:a + m].tobytes() for a, m in zip(cuts, most)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(c), b.column(2), smallest], names=["id", "n", "c", "t", "smallest"])

    def prefixes(batches: Iterator, sieve: Sieve | None = None) -> Iterator:
        for b in slices(batches, 4):
            data, offsets = hashed.bytes_of(b.column(4))
            h = data.view(np.int64)
            row = np.repeat(np.arange(b.num_rows), np.diff(offsets) // 8)
            if sieve:
                may = sieve.may_hold(h)
                row, h = row[may], h[may]
            of = pa.array(row)
            yield pa.RecordBatch.from_arrays([pa.array(h), b.column(2).take(of), b.column(1).take(of), b.column(0).take(of)], names=["token", "c", "n", "id"])

    def whole(batches: Iterator) -> Iterator:
        for b in slices(batches, 1):
            row, h, cuts = token_sets(b.column(1), k)
            c = set_digests(row, h, b.num_rows)
            sets = [h[a:z].tobytes() for a, z in zip(cuts, cuts[1:])]
            low = h[np.minimum(cuts[:-1], max(len(h) - 1, 0))].astype(np.int64) if len(h) else np.zeros(b.num_rows, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(low), pa.array(sets, pa.binary())], names=["c", "low", "tokens"])

    def apart(batches: Iterator) -> Iterator:
        for b in batches:
            data, offsets = hashed.bytes_of(b.column(1))
            of = pa.array(np.repeat(np.arange(b.num_rows), np.diff(offsets) // 8))
            yield pa.RecordBatch.from_arrays([pa.array(data.view(np.int64)), b.column(0).take(of)], names=["token", "c"])

    def candidates() -> tuple[DataFrame, DataFrame]:
        """``(ids, some)``: each row's set size and class, and the classes that can link by their smallest hashes; what is made on the way can go."""
        named = cut_lineage(d.mapInArrow(digests, "id long, n long, c long, t long, smallest binary"))  # texts are cut into shingles once
        ddl = "token long, c long, n long, id long"
        shared = cut_lineage(named.mapInArrow(prefixes, ddl).groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
                             .where("lo < hi").select("token"))
        sieve = Sieve(shared, F.col("token"))  # most tokens are of one class and need not be shuffled again
        tokens = named.mapInArrow(lambda batches: prefixes(batches, sieve), ddl)
        prefix = F.col("n") - F.floor((F.lit(percent) * F.col("n") + 99) / 100) + 1
        some = (tokens.join(shared, "token").groupBy("c", "n").agg(F.min("id").alias("id"), F.size(F.collect_set("token")).alias("held"))
                .where(F.col("held") > F.least(F.col("n"), F.floor((3 * prefix + 1) / 2)) - prefix).select("c", "id"))
        return cut_lineage(named.drop("smallest")), cut_lineage(some)

    def rare_tokens(whole_sets: DataFrame) -> DataFrame:
        """``c, low, tokens, kept`` for the sets whose tokens that others hold too are enough for a link: of these a linked pair shares one of the rarest, ``kept``."""
        holders = (whole_sets.select("c", "tokens").mapInArrow(apart, "token long, c long")
                   .withColumn("df", F.count("*").over(Window.partitionBy("token"))).where("df > 1"))
        least = F.floor((F.lit(percent) * (F.octet_length("tokens") / 8) + 99) / 100)
        return (holders.groupBy("c").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("t")).join(whole_sets, "c")
                .withColumn("room", (F.size("t") - least + 1).cast("int")).where("room > 0")
                .select("c", "low", "tokens", F.expr("transform(slice(t, 1, room), x -> x.token)").alias("kept")))

    ids, some = candidates()
    ids_left = some.select("id").distinct()
    of_them = Sieve(ids_left, F.xxhash64("id")).rows(d.withColumn("h", F.xxhash64("id")), "h").drop("h")
    texts = (of_them.join(ids_left, "id").select("id", "text").mapInArrow(whole, "c long, low long, tokens binary")
             .groupBy("c").agg(F.min("low").alias("low"), F.min("tokens").alias("tokens")))
    # smallest hashes alone let more and more texts through by chance as the input grows: whole sets decide
    sets = cut_lineage(rare_tokens(cut_lineage(texts.join(some.select("c"), "c", "left_semi"))))
    lows = sets.groupBy("low").agg(F.count("*").alias("texts"))
    deal = lambda turn: F.pmod(F.xxhash64(F.lit(turn), "c"), F.ceil(F.col("texts") / GROUP))
    placed = cut_lineage(sets.select("c", "low").join(lows, "low").select("c", "low", "texts", F.xxhash64("low", deal(0)).alias("g")))

    def inside(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("c")
        at = [np.frombuffer(x, np.uint64) for x in pdf["tokens"]]
        c = pdf["c"].to_numpy()
        return pd.DataFrame({"a": c, "b": c[linked(at, 0, percent)]})

    found = cut_lineage(placed.where("texts > 1").select("c", "g").join(sets.select("c", "tokens"), "c")
                        .groupBy("g").applyInPandas(inside, "a long, b long"))
    # groups dealt from one hash value: what stands for their linked texts meets again, as long as that shrinks
    active = placed.where(F.col("texts") > GROUP).select("c", "low")
    last, step = active.count(), found
    for turn in range(1, 12):
        if last < 2:
            break
        active = cut_lineage(active.join(step.where("a = b").select(F.col("a").alias("c")), "c").select("c", "low"))
        sizes = active.groupBy("low").agg(F.count("*").alias("texts")).where("texts > 1")
        now = sizes.agg(F.coalesce(F.sum("texts"), F.lit(0))).first()[0]
        if now < 2 or now > 0.9 * last and turn > 1:
            break
        step = cut_lineage(active.join(sizes, "low").withColumn("deal", deal(turn)).join(sets.select("c", "tokens"), "c")
                           .groupBy("low", "deal").applyInPandas(inside, "a long, b long"))
        found, last = found.union(step), now
    comps = min_labels(spark, found)
    member = placed.join(comps.withColumnRenamed("node", "c"), "c", "left").select("c", "g", F.coalesce("label", "c").alias("comp"))
    holds = (member.join(sets.select("c", "kept"), "c").select("g", "comp", F.explode("kept").alias("token"))
             .groupBy("token", "g").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")))
    holds = cut_lineage(holds)
    mixed = (holds.groupBy("token").agg(F.min("g").alias("g0"), F.max("g").alias("g1"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
             .where("g0 < g1 AND lo < hi").select("token", "g0"))
    matrix = cut_lineage(holds.join(mixed, "token"))
    # groups that hang together by shared tokens (each to the least one of its token) go on in bundles of about
    # BUNDLE bytes, so that each text travels once for each bundle that its own has to be held against
    family = min_labels(spark, matrix.where("g > g0").select(F.col("g").alias("a"), F.col("g0").alias("b"))).withColumnRenamed("node", "g")
    mine = member.select("c", "g").join(family, "g")
    weight = mine.join(sets.select("c", F.octet_length("tokens").alias("bytes")), "c").groupBy("label").agg(F.sum("bytes").alias("bytes"))
    bundle = F.xxhash64("label", F.pmod(F.xxhash64("g"), F.ceil(F.col("bytes") / BUNDLE)))
    mine = cut_lineage(mine.join(weight, "label").select("c", "g", bundle.alias("u")))
    cells = cut_lineage(matrix.join(mine.select("g", "u").distinct(), "g").groupBy("token", "u")
                        .agg(F.count("*").alias("groups"), F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    inner = cells.where("groups > 1 AND lo < hi").select(F.col("u").alias("xu"), F.col("u").alias("yu")).distinct()
    # tokens that stand in the same bundles name the same pairs: one of them is enough
    wide = (cells.groupBy("token").agg(F.count("*").alias("bundles"), F.bit_xor(F.xxhash64("u")).alias("which")).where("bundles > 1")
            .groupBy("bundles", "which").agg(F.min("token").alias("token")).select("token"))
    row = cells.join(wide, "token").select("token", "u")
    held = cut_lineage(inner.union(row.alias("x").join(row.alias("y"), "token").where("x.u < y.u")
                                   .select(F.col("x.u").alias("xu"), F.col("y.u").alias("yu")).distinct()))
    bundles = mine.join(sets.select("c", "tokens"), "c").groupBy("u").agg(F.collect_list(F.struct("c", "tokens")).alias("texts"))
    opened = (held.where("xu = yu").join(bundles.select(F.col("u").alias("xu"), F.col("texts").alias("x")), "xu")
              .select("x", F.lit(None).cast(bundles.schema["texts"].dataType).alias("y"))
              .union(held.where("xu < yu").join(bundles.select(F.col("u").alias("xu"), F.col("texts").alias("x")), "xu")
                     .join(bundles.select(F.col("u").alias("yu"), F.col("texts").alias("y")), "yu").select("x", "y")))

    def across(batches: Iterator) -> Iterator:
        for b in batches:
            a_out, b_out = [], []
            for x, y in zip(b.column(0), b.column(1)):
                sides = []
                for side in (x.values, y.values) if y.is_valid else (x.values,):
                    data, offsets = hashed.bytes_of(side.field(1))
                    sides.append(list(zip(side.field(0).to_pylist(), [data[i:j].view(np.uint64) for i, j in zip(offsets, offsets[1:])])))
                for mine in (0, 1) if y.is_valid else ():  # against the token union of the other group
                    union = np.unique(np.concatenate([s for _, s in sides[1 - mine]])) if sides[1 - mine] else np.empty(0, np.uint64)
                    of = np.repeat(np.arange(len(sides[mine])), [len(s) for _, s in sides[mine]])
                    hit = np.isin(np.concatenate([s for _, s in sides[mine]]), union) if len(of) else np.empty(0, bool)
                    got = np.bincount(of[hit], minlength=len(sides[mine]))
                    sides[mine] = [(c, s) for (c, s), n in zip(sides[mine], got) if n >= needed(len(s), percent)]
                if all(sides):
                    both = [x for side in sides for x in side]
                    root = linked([s for _, s in both], len(sides[0]) if len(sides) > 1 else 0, percent)
                    for i in np.flatnonzero(root != np.arange(len(both))):
                        a_out.append(both[i][0])
                        b_out.append(both[root[i]][0])
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["a", "b"])
    edges = comps.select(F.col("node").alias("a"), F.col("label").alias("b")).union(opened.mapInArrow(across, "a long, b long"))
    labels = min_labels(spark, edges)
    return (ids.join(labels.withColumnRenamed("node", "c"), "c", "left")
            .select("id", "n", "c", "t", F.when(F.col("n") > 0, F.coalesce("label", "c")).alias("label")))


def one_per_component(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` for each component, and all rows without words, which link with nothing.

    It is the component's first row by id (null first), digest of the set of
    shingles and digest of the text; rows equal in these are equal in text,
    and the first by a digest of all columns stays. Rows of other components
    stay whatever their ids are.
    """
    own, t, every, nth = (free_name(docs, n) for n in ("_id", "_t", "_all", "_nth"))
    keep = (_labelled(docs, k, percent, "doc_id", "text").where("label IS NOT NULL")
            .groupBy("label").agg(F.min(F.struct("id", "c", "t")).alias("first"))
            .select(F.col("first.id").alias(own), F.col("first.t").alias(t)))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.withColumns({own: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), t: F.xxhash64(F.coalesce("text", F.lit("")))})
    same = Window.partitionBy(own, t).orderBy(every)
    first = (keyed.join(keep, [own, t], "left_semi").withColumn(every, F.xxhash64(*columns))
             .withColumn(nth, F.row_number().over(same)).where(F.col(nth) == 1))
    wordless = docs.where(~F.coalesce(F.col("text").rlike(WORD), F.lit(False)))
    return first.select(*columns).union(wordless.select(*columns))
