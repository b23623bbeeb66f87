"""Operator 1: mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from palimpsest.llm.common import WORD, cut_lineage


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: int) -> DataFrame:
    """Target words of each source: ``(skey, rank, source_size, target)`` from ``(skey, source_size)``.

    Weights repeat over the sources in key order. The budget is ``share`` of
    all words; a target stops at ``most`` times its source, and the excess is
    dealt to the others by weight until none is above: ``min(cap, w * level)``
    with the one level at which the targets add up to the budget. One row a
    source passes through the two ordered windows here, never a document.
    """
    by_key, by_ratio = W.orderBy("skey"), W.orderBy("ratio", "skey")
    cyc = F.array(*[F.lit(float(w)) for w in weights])
    s = (sizes.withColumn("rank", F.row_number().over(by_key))
         .withColumn("w", F.element_at(cyc, ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
         .withColumn("cap", (F.col("source_size") * most).cast("double"))
         .withColumn("ratio", F.col("cap") / F.col("w")))
    everything = W.partitionBy(F.lit(1))
    s = (s.withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
         .withColumn("full", F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
         .withColumn("rest", F.sum("w").over(by_ratio.rowsBetween(W.currentRow, W.unboundedFollowing)))
         .withColumn("level", (F.col("budget") - F.col("full")) / F.col("rest"))
         .withColumn("level", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything)))
    return s.select("skey", "rank", "source_size", "budget",
                    F.coalesce(F.least("cap", F.col("w") * F.col("level")), F.col("cap")).alias("target"))


def mix_sources(docs: DataFrame, weights: Sequence[float], share: float = 1.5, most: int = 2,
                seed: str = "mix", doc_id: str = "doc_id", text: str = "text", source: str = "source",
                key: str | None = None) -> DataFrame:
    """Words each document gives to a mix of its sources: one row per row of ``docs``.

    Within a source documents queue in shuffled order (md5 of seed, id and a
    digest of the text, so that rows that share an id spread too). A
    document's virtual finish time is the source's words up to its end over
    the source's target; a further pass through the source adds its size.
    All passes are ordered by finish time over all sources, and the mix is cut
    where the running total meets the budget. A pass that would go beyond its
    source's target, rounded up, is cut there, and the budget is rounded down,
    so the sources' taken words miss their targets by about the number of
    sources at most.

    Returns ``doc_id, source, size, source_size, target, taken, mix_offset``;
    ``mix_offset`` counts the words of the mix before the document's first
    pass (null where none is taken). Null text has size 0; documents of size 0
    take nothing; repeated rows queue one by one; no rows give no rows. A
    column ``key`` (long) breaks ties in the queue and goes on to the result.

    Running totals are made in two steps (sums of buckets, then offsets inside
    each), with the square root of the document count as bucket count, so that
    a source with most of the rows is spread like any other; so is a null or
    repeated id. Only rows equal in source, id and text share a place.
    """
    own = ["key"] if key else []
    rows = docs.select(
        F.col(doc_id).alias("id"), *[F.col(key).alias(x) for x in own],
        F.coalesce(F.concat(F.lit("1"), F.col(source)), F.lit("2")).alias("skey"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit("|"),
                       F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))).cast("binary")).alias("shuf"))
    nb = max(1, math.isqrt(docs.count()))
    rows = cut_lineage(rows.withColumn(
        "bucket", F.floor(F.conv(F.substring("shuf", 1, 8), 16, 10).cast("long") * nb / F.lit(2 ** 32)).cast("int")))

    sums = rows.groupBy("skey", "bucket").agg(F.sum("size").alias("words"))
    before = W.partitionBy("skey").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.withColumn("offset", F.coalesce(F.sum("words").over(before), F.lit(0)))
    targets = source_targets(sums.groupBy("skey").agg(F.sum("words").alias("source_size")), weights, share, most)
    offsets = offsets.join(targets, "skey").drop("words")

    inside = W.partitionBy("skey", "bucket").orderBy("shuf", "id", "size", *own)
    queue = (rows.join(offsets, ["skey", "bucket"])
             .withColumn("nth", F.row_number().over(inside))
             .withColumn("end", F.col("offset") + F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, W.currentRow)))
             .withColumn("lot", F.ceil("target")))
    passes = queue.select("*", F.explode_outer(F.filter(
        F.sequence(F.lit(0), F.lit(most - 1)),
        lambda k: (F.col("size") > 0) & (k * F.col("source_size") + F.col("end") - F.col("size") < F.col("lot")))).alias("pass"))
    start = F.col("pass") * F.col("source_size") + F.col("end") - F.col("size")
    passes = (passes.withColumn("served", F.when(start.isNull(), 0).otherwise(F.least(F.col("size"), F.col("lot") - start)))
              .withColumn("finish", F.coalesce((start + F.col("served")) / F.col("target"), F.lit(0.0)))
              .withColumn("span", F.when(F.col("pass").isNull(), F.pmod(F.xxhash64("skey", "bucket", "nth"), F.lit(nb)))
                          .otherwise(F.least(F.floor(F.col("finish") * nb), F.lit(nb))).cast("int")))

    spans = passes.groupBy("span").agg(F.sum("served").alias("words"))
    spans = spans.select("span", F.coalesce(F.sum("words").over(
        W.orderBy("span").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
    order = W.partitionBy("span").orderBy("finish", "skey", "pass", "end", "size")
    mixed = (passes.join(spans, "span")
             .withColumn("ahead", F.col("earlier") + F.sum("served").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("served"))
             .withColumn("got", F.greatest(F.lit(0), F.least(F.col("served"), F.floor("budget") - F.col("ahead")))))
    return (mixed.groupBy("skey", "bucket", "nth", "id", *own, "size", "source_size", "target")
            .agg(F.sum("got").cast("long").alias("taken"),
                 F.min(F.when(F.col("got") > 0, F.col("ahead"))).alias("mix_offset"))
            .select(F.col("id").alias("doc_id"), F.when(F.col("skey").startswith("1"), F.expr("substring(skey, 2)")).alias("source"),
                    "size", "source_size", "target", "taken", "mix_offset", *[F.col(x).alias(key) for x in own]))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce('1' || source, '2') AS skey,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))) AS shuf
  FROM documents),
s AS (SELECT skey, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY skey),
r AS (SELECT *, row_number() OVER (ORDER BY skey) AS rank FROM s),
w AS (SELECT *, [3.0, 1.0, 2.0][CAST((rank - 1) % 3 AS INT) + 1]::DOUBLE AS w,
             CAST(source_size * 2 AS DOUBLE) AS cap FROM r),
v AS (SELECT *, cap / w AS ratio, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS budget FROM w),
l AS (SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY ratio, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (ORDER BY ratio, skey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM v),
m AS (SELECT *, max(CASE WHEN lev <= ratio THEN lev END) OVER () AS level FROM l),
t AS (SELECT skey, source_size, budget, coalesce(least(cap, w * level), cap) AS target FROM m),
q AS (SELECT d.*, t.source_size, t.budget, t.target, CAST(ceil(t.target) AS BIGINT) AS lot,
             row_number() OVER (PARTITION BY skey ORDER BY shuf, doc_id, size) AS nth,
             CAST(sum(size) OVER (PARTITION BY skey ORDER BY shuf, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS "end"
      FROM d JOIN t USING (skey)),
p AS (SELECT q.*, k.pass, least(size, lot - (k.pass * source_size + "end" - size)) AS served,
             k.pass * source_size + "end" - size AS start
      FROM q, (VALUES (0), (1)) k(pass)
      WHERE size > 0 AND k.pass * source_size + "end" - size < lot),
o AS (SELECT *, CAST(sum(served) OVER (ORDER BY CAST(start + served AS DOUBLE) / target, skey, pass, "end", size
                                       ROWS UNBOUNDED PRECEDING) AS BIGINT) - served AS ahead FROM p),
g AS (SELECT skey, nth, CAST(sum(greatest(0, least(served, CAST(floor(budget) AS BIGINT) - ahead))) AS BIGINT) AS taken,
             min(CASE WHEN least(served, CAST(floor(budget) AS BIGINT) - ahead) > 0 THEN ahead END) AS mix_offset
      FROM o GROUP BY ALL)
SELECT q.doc_id, CASE WHEN q.skey LIKE '1%' THEN substr(q.skey, 2) END AS source, q.size, q.source_size, q.target,
       coalesce(g.taken, 0) AS taken, g.mix_offset
FROM q LEFT JOIN g USING (skey, nth)
"""
