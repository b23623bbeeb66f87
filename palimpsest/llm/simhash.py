"""Operator 5: document fingerprints (SimHash) and their search within a Hamming radius."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from palimpsest.llm.common import ascii_lower, cut_lineage, ranged

BITS = 64
PAIR = (1 << 32) | 1  # two 32-bit counters in one long
NO_ID = -(1 << 63)  # stands for a null id


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def simhash(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and ``fingerprint`` (long): bit b is set where the terms whose hash has it set outweigh the others.

    Terms are the runs of 3 words (shorter at the end; A-Z lower-cased); a
    term weighs as much as its first word has letters, 7 at most, each time it
    occurs, and its hash votes with that weight. The votes of two bits share
    one long, so 32 sums serve 64 bits. Equal texts get equal fingerprints; a
    text without words, or null, gets 0. ``keys`` must tell rows apart. Where
    ``texts`` is hashed on one of the keys already, nothing is shuffled.
    """
    hashed = texts.withColumn("_hashes", F.transform(
        F.filter(F.split(ascii_lower(F.col(text)), r"[\x20\x09-\x0D]+"), lambda w: w != ""),
        lambda w: F.struct(F.xxhash64(w).alias("h"), F.least(F.length(w), F.lit(7)).cast("long").alias("w"))))
    terms = F.transform("_hashes", lambda x, i: F.struct(
        F.xxhash64(x["h"], F.get(F.col("_hashes"), i + 1)["h"], F.get(F.col("_hashes"), i + 2)["h"]).alias("h"), x["w"].alias("w")))
    votes = hashed.select(*keys, F.explode_outer(terms).alias("t")).select(*keys, F.col("t.h").alias("h"), F.col("t.w").alias("w"))
    sums = [F.sum(F.shiftrightunsigned("h", j).bitwiseAND(F.lit(PAIR)) * F.col("w")).alias(f"v{j}") for j in range(32)]
    agg = votes.groupBy(*keys).agg(F.sum("w").alias("total"), *sums)
    bits = None
    for j in range(32):
        for b, n in ((j, F.col(f"v{j}").bitwiseAND(F.lit((1 << 32) - 1))), (j + 32, F.shiftrightunsigned(f"v{j}", 32))):
            bit = F.when(n * 2 > F.col("total"), F.lit(signed(1 << b))).otherwise(F.lit(0).cast("long"))
            bits = bit if bits is None else bits.bitwiseOR(bit)
    return agg.select(*keys, bits.alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def block_masks(radius: int, spare: int = 3) -> list[int]:
    """Masks of permuted tables: the bits in ``radius + spare`` blocks, all but ``radius`` of them in each mask.

    Two fingerprints that differ in ``radius`` bits or fewer differ in that
    many blocks at most, so they agree under one of the masks.
    """
    n = radius + spare
    edges = [BITS * i // n for i in range(n + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(blocks, spare)]


def within_radius(queries: DataFrame, table: DataFrame, radius: int = 3, spare: int = 3) -> DataFrame:
    """All pairs ``(query, fingerprint)`` of distinct fingerprints at most ``radius`` bits apart.

    Both inputs have a column ``fingerprint``; copies are dropped first. Each
    fingerprint goes into one table per mask, keyed by its masked bits; a pair
    is kept only in the first table in which it meets, so it comes out once.
    """
    masks = [signed(m) for m in block_masks(radius, spare)]
    lit = F.array(*[F.lit(m).cast("long") for m in masks])

    def keyed(df: DataFrame, name: str) -> DataFrame:
        one = df.select(F.col("fingerprint").alias(name)).where(F.col(name).isNotNull()).distinct()
        return (one.select(name, F.posexplode(lit).alias("table", "mask"))
                .select(name, "table", F.col(name).bitwiseAND(F.col("mask")).alias("key")))
    q, t = keyed(queries, "query"), keyed(table, "fingerprint")
    x = F.col("query").bitwiseXOR(F.col("fingerprint"))
    close = q.join(t, ["table", "key"]).where(
        (F.bit_count(x) <= radius) & ~F.exists(F.filter(lit, lambda m, i: i < F.col("table")), lambda m: x.bitwiseAND(m) == 0))
    return close.select("query", "fingerprint")


def next_ids(ids: DataFrame) -> DataFrame:
    """``ids`` (distinct ``id``) with the next larger id (``next_id``; after the last the first)."""
    parts = ranged(ids, F.col("id"))
    ends = parts.groupBy("_part").agg(F.min("id").alias("low"))  # a row per range
    after = W.orderBy("_part").rowsBetween(1, W.unboundedFollowing)
    ends = ends.select("_part", F.coalesce(F.min("low").over(after), F.min("low").over(W.partitionBy(F.lit(1)))).alias("follow"))
    inside = W.partitionBy("_part").orderBy("id")
    return (parts.join(F.broadcast(ends), "_part")
            .withColumn("next_id", F.coalesce(F.lead("id").over(inside), F.col("follow"))).drop("_part", "follow"))


def fingerprint_documents(docs: DataFrame, radius: int = 3, every: int = 100, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of whole texts and of their edited form, one row per row of ``docs``.

    The edited text has its last quarter (code points, rounded down) replaced
    by the first as many of the next document in ascending id, the first after
    the last. Returns ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint`` (16 hex digits), ``near_edited, near_next`` (share of
    equal bits) and ``n_near``: for ids divisible by ``every`` the number of
    rows, itself included, whose fingerprint is within ``radius`` bits, else null.

    Null text is empty; a null id comes first in the order. Rows that repeat
    an id have the same next document; if the next id itself repeats, the
    smallest of the beginnings and fingerprints counts. A lone document is its own next.
    """
    # rows that share an id join its next document's beginning on one key: such a join is split even where that costs a further exchange
    docs.sparkSession.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    d = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    follow = next_ids(d.groupBy("id").agg(F.max(F.floor(F.length("text") / 4)).alias("most")))
    heads = (d.join(follow.select(F.col("id").alias("of"), F.col("next_id").alias("id"), "most"), "id")
             .select("of", F.col("id").alias("next_id"), F.expr("substring(text, 1, int(most))").alias("head"))
             .groupBy("of", "next_id").agg(F.min("head").alias("head")))
    both = (d.join(heads.withColumnRenamed("of", "id"), "id")
            .withColumn("n_chars", F.length("text").cast("long"))
            .withColumn("edited", F.expr("concat(substring(text, 1, int(n_chars - floor(n_chars / 4))), substring(head, 1, int(floor(n_chars / 4))))"))
            .withColumn("row", F.monotonically_increasing_id())  # tells rows apart within a task; never leaves it
            .select("id", "next_id", "row", "n_chars", F.explode(F.array(
                F.struct(F.lit(0).alias("edit"), F.lit("").alias("sha"), F.col("text").alias("text")),
                F.struct(F.lit(1).alias("edit"), F.sha2(F.col("edited").cast("binary"), 256).alias("sha"), F.col("edited").alias("text")))).alias("x"))
            .select("id", "next_id", "row", "n_chars", "x.*"))
    prints = (simhash(both, ["id", "next_id", "row", "n_chars", "edit", "sha"])
              .groupBy("id", "next_id", "row", "n_chars")
              .agg(F.max("sha").alias("edited_sha256"), F.max(F.when(F.col("edit") == 0, F.col("fingerprint"))).alias("fingerprint"),
                   F.max(F.when(F.col("edit") == 1, F.col("fingerprint"))).alias("edited_fingerprint")))
    prints = cut_lineage(prints)  # a few dozen bytes a document, read three times below
    nexts = prints.groupBy("id").agg(F.min("fingerprint").alias("next_fingerprint")).withColumnRenamed("id", "next_id")
    asked = prints.where((F.col("id") % every == 0) & (F.col("id") != NO_ID))
    copies = prints.groupBy("fingerprint").agg(F.count("*").alias("n"))
    near = (within_radius(asked, prints, radius).join(copies, "fingerprint")
            .groupBy(F.col("query").alias("fingerprint")).agg(F.sum("n").alias("n_near")))
    hexa = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    return (prints.join(nexts, "next_id").join(near, "fingerprint", "left")
            .select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "n_chars", "edited_sha256",
                    hexa("fingerprint").alias("fingerprint"), hexa("edited_fingerprint").alias("edited_fingerprint"),
                    likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                    likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
                    F.when((F.col("id") % every == 0) & (F.col("id") != NO_ID), F.col("n_near")).alias("n_near")))
