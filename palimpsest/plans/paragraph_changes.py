"""Paragraph comparison job: snapshot logs -> new / deleted paragraphs ->
pairing -> change flag -> shift test -> noise cascade -> one row per chapter.

Plan shape: both logs are exploded in place (no shuffle); pairing joins on
``(doc_id, k)``; the shift test joins a per-document text index; the cascade
windows are per chapter, i.e. per document, whose size is bounded by one input
row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.constants import CLICK_TO_VIEW
from palimpsest.functions.text import any_changed
from palimpsest.operators import paragraphs, relevance, report, scoring
from palimpsest.session import cut_lineage


def trim_space(c):
    """D3 as the paragraph job writes it: one trailing space removed."""
    return F.regexp_replace(F.col(c) if isinstance(c, str) else c, r" \z", "")


def logs(prev: DataFrame, latest: DataFrame, together: bool = False) -> tuple[DataFrame, DataFrame]:
    """F4 + W3 on both snapshots: ``(doc_id, chapter, manual, title, k, pos, para, key)``.

    Numbering happens inside the document's row, without an exchange. With
    ``together`` both logs are dealt by ``doc_id`` once, which then serves the
    pairing, the shift test and the windows of the comparison.
    """
    both = paragraphs.numbered_paragraphs(prev), paragraphs.numbered_paragraphs(latest)
    return tuple(log.repartition("doc_id") for log in both) if together else both


def new_paragraphs(plog: DataFrame, llog: DataFrame) -> DataFrame:
    """J4 ``right_only`` / J4b: keys only in the latest log."""
    return paragraphs.remove_keys(llog, plog)


def deleted_paragraphs(plog: DataFrame, llog: DataFrame) -> DataFrame:
    """J4 swapped / J4b: keys only in the previous log."""
    return paragraphs.remove_keys(plog, llog)


def paired(plog: DataFrame, llog: DataFrame) -> DataFrame:
    """J4b + D3 + J5: one-sided keys removed, trimmed, paired by key."""
    p = plog.select("doc_id", "k", "key", "chapter", F.col("chapter").alias("prev_chapter"),
                    F.col("title").alias("prev_title"), trim_space("para").alias("prev_para"))
    c = llog.select("doc_id", "k", F.col("chapter").alias("curr_chapter"),
                    F.col("title").alias("curr_title"), trim_space("para").alias("curr_para"))
    return p.join(c, ["doc_id", "k"])


def changed(pairs: DataFrame) -> DataFrame:
    """keep pairs whose chapter, title or paragraph changed."""
    flag = any_changed([("prev_chapter", "curr_chapter"), ("prev_title", "curr_title"),
                        ("prev_para", "curr_para")])
    return pairs.where(flag)


def with_shift(changed_pairs: DataFrame, llog: DataFrame) -> DataFrame:
    """Is the old paragraph found at another position of the new document?"""
    target = llog.select("doc_id", F.col("k").alias("pos"), trim_space("para").alias("text"))
    pairs = changed_pairs.withColumn("pos", F.col("k"))
    return paragraphs.mark_found_elsewhere(pairs, target, "prev_para", "shifted").drop("pos")


def summary_of_logs(plog: DataFrame, llog: DataFrame, refs: DataFrame | None = None) -> DataFrame:
    """The job's main output from two logs: first remaining change per chapter with its counts.

    J4b -> F11 -> J8 -> F13 -> W1 -> D2/D1/F12 -> W2, then J7 (referring
    documents) when ``refs`` is given. Both logs are dealt by ``doc_id`` once.
    """
    plog, llog = plog.repartition("doc_id"), llog.repartition("doc_id")
    flagged = with_shift(changed(paired(plog, llog)), llog)
    out = scoring.paragraph_noise_cascade(flagged).select(
        "doc_id", "chapter", F.col("prev_title").alias("title"), "k", "prev_para", "curr_para",
        "n_paras_with_changes", "char_count_diff", "lev_distance")
    return out if refs is None else relevance.lookup_refs(out, refs)


def chapter_summary(prev: DataFrame, latest: DataFrame, refs: DataFrame | None = None) -> DataFrame:
    """:func:`summary_of_logs` on two snapshots."""
    return summary_of_logs(*logs(prev, latest), refs)


def chapter_list(summary: DataFrame) -> DataFrame:
    """W2 + O1: the published list of changed chapters, ranked by their number of changed paragraphs (chapter breaks ties).

    ``summary``: :func:`chapter_summary` with referring documents.
    """
    ranked = report.ranked(cut_lineage(summary), F.desc("n_paras_with_changes"), F.asc("chapter"), F.asc("doc_id"))
    return ranked.select("rank", "chapter", F.replace("title", F.lit("Previous"), F.lit("")).alias("title"), F.col("doc_info").alias("found_in"),
                         "n_paras_with_changes", F.lit(CLICK_TO_VIEW).alias("link_to_changes"))
