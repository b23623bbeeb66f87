"""Scoring: per-document metrics (A3), significance (F2), threshold flag (F3),
and the paragraph noise cascade of the paragraph comparison (F13, W1, F12, W2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from palimpsest.constants import SIGNIFICANCE_THRESHOLD
from palimpsest.functions.text import (
    length_diff,
    levchar_flag,
    significant,
    trim_trailing_blank,
)
from palimpsest.functions.distance import long_edit_distance, long_exceeds, place_distances, total_distance
from palimpsest.operators.snapshot import changed_pairs

DOC = "doc_id"


def document_metrics(prev: DataFrame, latest: DataFrame, mode: str = "content") -> DataFrame:
    """A3: one row per changed document.

    ``lev_distance`` whole-text distance, ``char_count_diff`` length
    difference, ``text_lev_total`` sum of paragraph distances over the full
    outer positional pairing (missing side = ''), ``para_change_count``
    differing pairs, ``para_count`` pairs. Paragraph counts are 0 when the
    whole-text distance is 0.

    Plan: one join of the two snapshots on ``doc_id`` (one exchange per
    side) and nothing else: the paragraph pairing is ``arrays_zip`` inside the
    joined row (it pads the shorter side with NULL), and the distances of the
    pairs that differ are summed over those arrays in the same row. All
    distances are exact and computed bit-parallel in Arrow batches (the
    built-in walks the full matrix at ~25 ns a cell).
    """
    return pair_metrics(changed_pairs(prev, latest, mode=mode))


def pair_metrics(j: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """A3's columns over rows that hold both texts (see :func:`document_metrics`), with the columns ``keep``."""
    split = lambda c: F.transform(F.split(c, "\n"), trim_trailing_blank)
    zipped = F.arrays_zip(split("prev_text").alias("p"), split("curr_text").alias("c"))
    staged = j.select(DOC, *keep, "manual", "chapter", "prev_title", "prev_text", "curr_text", zipped.alias("_z"))
    side = lambda s, n: F.coalesce(s[n], F.lit(""))
    differing = F.filter("_z", lambda s: side(s, "p") != side(s, "c"))
    staged = staged.select("*", differing.alias("_d")).select(
        "*", F.transform("_d", lambda s: side(s, "p")).alias("_dp"), F.transform("_d", lambda s: side(s, "c")).alias("_dc"))
    out = staged.select(
        DOC, *keep, F.col("manual").alias("source"), F.col("chapter").alias("chapter_number"),
        F.col("prev_title").alias("title"),
        long_edit_distance("prev_text", "curr_text").alias("lev_distance"),
        length_diff("prev_text", "curr_text").cast("long").alias("char_count_diff"),
        total_distance("_dp", "_dc").alias("_tlt"),
        F.size("_d").cast("long").alias("_pcc"),
        F.size("_z").cast("long").alias("_pc"))
    positive = F.col("lev_distance") > 0
    return out.select(
        DOC, *keep, "source", "chapter_number", "title", "lev_distance", "char_count_diff",
        F.when(positive, F.col("_tlt")).otherwise(0).alias("text_lev_total"),
        F.when(positive, F.col("_pcc")).otherwise(0).alias("para_change_count"),
        F.when(positive, F.col("_pc")).otherwise(0).alias("para_count"))


def significant_changes(metrics: DataFrame) -> DataFrame:
    """keep documents with changed paragraphs and distance above 50."""
    return metrics.where(significant("lev_distance", "para_change_count"))


def threshold_flags(prev: DataFrame, latest: DataFrame) -> DataFrame:
    """``above_threshold`` per document of the latest snapshot.

    Changed documents: whole-text distance > 50 by the bounded algorithm;
    new and deleted documents: TRUE by default; unchanged: FALSE.
    """
    p = prev.select(DOC, F.col("text").alias("prev_text"))
    c = latest.select(DOC, F.col("text").alias("curr_text"))
    j = p.join(c, DOC, "full_outer")
    update_type = (F.when(F.col("prev_text").isNull(), "new")
                   .when(F.col("curr_text").isNull(), "deletion")
                   .when(F.col("prev_text") != F.col("curr_text"), "change")
                   .otherwise("same"))
    # Whole documents: length difference and character-multiset distance are
    # lower bounds that settle most rows; the rest get the exact distance,
    # bit-parallel (the built-in's bounded form still walks the full matrix).
    # Texts that aren't compared don't go to Python: their places are empty.
    j = j.withColumn("update_type", update_type)
    text = lambda c: F.when(F.col("update_type") == "change", F.col(c)).otherwise(F.lit(""))
    staged = j.select(DOC, "update_type", text("prev_text").alias("prev_text"), text("curr_text").alias("curr_text"))
    flag = F.col("update_type").isin("new", "deletion") | long_exceeds("prev_text", "curr_text", SIGNIFICANCE_THRESHOLD)
    return staged.select(DOC, "update_type", flag.alias("above_threshold"))


def paragraph_noise_cascade(changed: DataFrame) -> DataFrame:
    """F13 -> W1 -> D2/D1/F12 -> W2 on changed paragraph pairs.

    Input: changed pairs ``(chapter, title, k, prev_para, curr_para, shifted)``.
    W1 counts the unshifted changed paragraphs per chapter *before* F12 drops
    the cosmetic ones (this order decides the counts). W2 keeps the first
    remaining paragraph of each chapter. Output: one row per chapter.
    """
    # A chapter is one document: partitioning by (doc_id, chapter) keeps the
    # per-chapter semantics and reuses the doc_id hash partitioning.
    kept = changed.where(~F.col("shifted"))
    counted = kept.withColumn("n_paras_with_changes",
                              F.count(F.lit(1)).over(Window.partitionBy("doc_id", "chapter")).cast("long"))
    # A chapter's rows go to the distance as one array, because rows that come
    # back from Python have lost their partitioning and would be exchanged again.
    fields = counted.columns
    chapters = counted.groupBy("doc_id", "chapter").agg(
        F.sort_array(F.collect_list(F.struct("k", *[c for c in fields if c != "k"]))).alias("_rows"))
    texts = chapters.select("_rows", F.transform("_rows", lambda s: s["prev_para"]).alias("_p"), F.transform("_rows", lambda s: s["curr_para"]).alias("_c"))
    measured = texts.select("_rows", place_distances("_p", "_c").alias("_lev"))
    scored = F.transform(F.arrays_zip("_rows", "_lev"), lambda s: F.struct(
        s["_rows"].alias("row"), length_diff(s["_rows"]["prev_para"], s["_rows"]["curr_para"]).cast("long").alias("char_count_diff"),
        s["_lev"].alias("lev_distance")))
    first = F.try_element_at(F.filter(scored, lambda s: levchar_flag(s["lev_distance"], s["char_count_diff"])), F.lit(1))
    return (measured.select(first.alias("_first")).where(F.col("_first").isNotNull())
            .select(*[F.col(f"_first.row.{c}").alias(c) for c in fields], "_first.char_count_diff", "_first.lev_distance"))
