"""Paragraph-level operators: explode, number, pair, match, align.

Design notes (scale):
* A document is one row. Work that only looks inside one document —
  numbering the kept paragraphs (W3), the next paragraph (the ``lead`` of W5)
  — is done with array functions on that row *before* exploding, so it needs
  no shuffle and no window sort.
* Exploded paragraph tables are hash-partitioned on ``doc_id`` once. Joins
  on ``(doc_id, pos)`` / ``(doc_id, hash(text))`` and windows per document
  reuse that partitioning (``requireAllClusterKeysForCoPartition=false``);
  steps that need the text of the other side at another place, or a window per
  chapter, add theirs (the counts are pinned in ``tests/test_plans.py``).
* Work that compares the two snapshots joins on ``(doc_id, pos)`` or on
  ``(doc_id, hash(text))``. Repeated lines inside a document become one
  aggregated row before the join (map-side combine), so a paragraph repeated
  thousands of times cannot blow up a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from palimpsest.constants import NOT_AVAILABLE
from palimpsest.functions.text import content_hash, is_kept_paragraph, trim_trailing_blank

DOC = "doc_id"


def paragraph_array(text="text", trim: bool = True) -> Column:
    """D13 (text form): split a document on newlines; optionally D3-trim each line."""
    arr = F.split(F.col(text) if isinstance(text, str) else text, "\n")
    return F.transform(arr, trim_trailing_blank) if trim else arr


def explode_paragraphs(docs: DataFrame, keep=("chapter", "manual"), text: str = "text",
                       trim: bool = True, with_next: bool = False) -> DataFrame:
    """One row per paragraph: ``(doc_id, *keep, pos, text[, next_text])``.

    ``next_text`` is the following paragraph of the same document, read from
    the array in place (no window, no shuffle).
    """
    keep = [k for k in keep if k in docs.columns]
    d = docs.select(DOC, *keep, paragraph_array(text, trim).alias("_paras"))
    paras = F.col("_paras")

    def item(p, i):
        fields = [i.alias("pos"), p.alias("text")]
        if with_next:
            fields.append(F.try_element_at(paras, i + 2).alias("next_text"))
        return F.struct(*fields)

    return d.select(DOC, *keep, F.inline(F.transform(paras, item))).repartition(DOC)


def numbered_paragraphs(docs: DataFrame, keep=("chapter", "manual", "title"),
                        text: str = "text") -> DataFrame:
    """F4 + W3: drop noise paragraphs, number the kept ones ``k = 0, 1, ...``.

    The filter runs on the array, so ``k`` counts kept rows only, and the
    ``chapter_k`` key matches the snapshot log format.
    """
    keep = [k for k in keep if k in docs.columns]
    # A missing chapter number or title reads as 'NA' in the log.
    docs = docs.select(DOC, *[F.coalesce(F.col(k), F.lit(NOT_AVAILABLE)).alias(k)
                              if k in ("chapter", "title") else F.col(k) for k in keep], text)
    tagged = F.transform(F.split(F.col(text), "\n"), lambda p, i: F.struct(i.alias("pos"), p.alias("para")))
    kept = F.filter(tagged, lambda s: is_kept_paragraph(s["para"]))
    return (docs.select(DOC, *keep, F.posexplode(kept).alias("k", "_s"))
            .select(DOC, *keep, "k", F.col("_s.pos").alias("pos"), F.col("_s.para").alias("para"),
                    F.concat_ws("_", F.col("chapter"), F.col("k").cast("string")).alias("key")))


def pair_paragraphs(pp: DataFrame, lp: DataFrame, how: str = "full_outer") -> DataFrame:
    """J5 (``inner``) / J6 (``full_outer``): pair old and new paragraphs by position.

    Output ``(doc_id, pos, prev_text, curr_text, status)`` with status
    ``same | changed | inserted | deleted``.
    """
    p = pp.select(DOC, "pos", F.col("text").alias("prev_text"))
    c = lp.select(DOC, "pos", F.col("text").alias("curr_text"))
    status = (F.when(F.col("prev_text").isNull(), "inserted")
              .when(F.col("curr_text").isNull(), "deleted")
              .when(F.col("prev_text") == F.col("curr_text"), "same")
              .otherwise("changed"))
    return p.join(c, [DOC, "pos"], how).withColumn("status", status)


def pair_in_row(pairs: DataFrame, keep=("chapter", "manual")) -> DataFrame:
    """J6 for documents that already meet in one row (``prev_text``, ``curr_text``).

    ``arrays_zip`` of the two trimmed paragraph arrays pads the shorter side
    with NULL — the full outer positional pairing — and ``posexplode`` turns it
    into rows in place: no paragraph-level exchange, and the rows keep the
    join's ``doc_id`` partitioning for any per-document step after it.
    """
    keep = [k for k in keep if k in pairs.columns]
    z = F.arrays_zip(paragraph_array("prev_text").alias("p"), paragraph_array("curr_text").alias("c"))
    rows = pairs.select(DOC, *keep, F.posexplode_outer(z).alias("pos", "_pc")).where(F.col("_pc").isNotNull())
    status = (F.when(F.col("prev_text").isNull(), "inserted")
              .when(F.col("curr_text").isNull(), "deleted")
              .when(F.col("prev_text") == F.col("curr_text"), "same")
              .otherwise("changed"))
    return (rows.select(DOC, *keep, "pos", F.col("_pc.p").alias("prev_text"), F.col("_pc.c").alias("curr_text"))
            .withColumn("status", status))


def _text_index(side: DataFrame, text: str = "text") -> DataFrame:
    """Distinct ``(doc_id, h, text)`` of one side with the positions it holds.

    Partial aggregation collapses repeated lines before the exchange.
    """
    return (side.where(F.col(text).isNotNull())
            .groupBy(DOC, content_hash(text).alias("_h"), F.col(text).alias("_t"))
            .agg(F.count(F.lit(1)).alias("_n"), F.min("pos").alias("_min_pos")))


def mark_found_elsewhere(pairs: DataFrame, other: DataFrame, text_col: str = "prev_text",
                         flag: str = "shifted") -> DataFrame:
    """Flag rows whose ``text_col`` occurs at another position of ``other``.

    ``other`` is one side's paragraphs ``(doc_id, pos, text)``. Because the
    index holds one row per distinct text, the left join never duplicates rows.
    """
    idx = _text_index(other)
    j = pairs.join(idx, (pairs[DOC] == idx[DOC]) & (content_hash(pairs[text_col]) == idx["_h"])
                   & (pairs[text_col] == idx["_t"]), "left")
    found = F.coalesce((idx["_n"] > 1) | (idx["_min_pos"] != pairs["pos"]), F.lit(False))
    return j.select(pairs["*"], found.alias(flag))


def found_nowhere(side: DataFrame, other: DataFrame) -> DataFrame:
    """Paragraphs of ``side`` whose text occurs nowhere in the same document of ``other``.

    New-only texts are insertions, old-only texts deletions. Empty/NULL text
    is removed first.
    """
    s = side.where(F.col("text").isNotNull()).withColumn("_h", content_hash("text"))
    o = other.where(F.col("text").isNotNull()).select(DOC, content_hash("text").alias("_oh"),
                                                       F.col("text").alias("_ot"))
    cond = (s[DOC] == o[DOC]) & (s["_h"] == o["_oh"]) & (s["text"] == o["_ot"])
    return s.join(o, cond, "left_anti").drop("_h")


def look_ahead_status(pp_next: DataFrame, lp_next: DataFrame) -> DataFrame:
    """One-row look-ahead classification on the inner positional pairing.

    ``same`` when equal; ``deleted`` when the next old paragraph equals the
    current new one; ``inserted`` when the old one equals the next new one;
    else ``changed``. Inputs come from ``explode_paragraphs(with_next=True)``.
    """
    p = pp_next.select(DOC, "pos", F.col("text").alias("prev_text"), F.col("next_text").alias("prev_next"))
    c = lp_next.select(DOC, "pos", F.col("text").alias("curr_text"), F.col("next_text").alias("curr_next"))
    status = (F.when(F.col("prev_text") == F.col("curr_text"), "same")
              .when(F.col("prev_next") == F.col("curr_text"), "deleted")
              .when(F.col("prev_text") == F.col("curr_next"), "inserted")
              .otherwise("changed"))
    return p.join(c, [DOC, "pos"]).select(DOC, "pos", "prev_text", "curr_text", status.alias("status"))


def look_ahead_status_rows(old_rows: DataFrame, new_rows: DataFrame, part: str, order: str,
                           text: str = "text") -> DataFrame:
    """W5 for sources that are already one row per paragraph (e.g. conversation turns).

    Uses ``lead`` over ``partitionBy(part).orderBy(order)``.
    """
    w = Window.partitionBy(part).orderBy(order)
    o = old_rows.select(part, order, F.col(text).alias("prev_text"),
                        F.lead(text).over(w).alias("prev_next"))
    n = new_rows.select(part, order, F.col(text).alias("curr_text"),
                        F.lead(text).over(w).alias("curr_next"))
    status = (F.when(F.col("prev_text") == F.col("curr_text"), "same")
              .when(F.col("prev_next") == F.col("curr_text"), "deleted")
              .when(F.col("prev_text") == F.col("curr_next"), "inserted")
              .otherwise("changed"))
    return o.join(n, [part, order]).select(part, order, "prev_text", "curr_text", status.alias("status"))


def deletion_runs(pp: DataFrame, lp: DataFrame) -> DataFrame:
    """Runs of consecutive deleted old paragraphs, anchored to the kept one before.

    A paragraph is deleted when its text occurs nowhere in the new document
    (J15). ``anchor_pos`` is the position of the last kept paragraph before the
    run (NULL = start of the document); deleted rows sharing an anchor form one
    maximal run, so the island id needs a single running ``max`` window.
    Output: ``(doc_id, anchor_pos, start_pos, end_pos, n_paras, texts)``.
    """
    idx = _text_index(lp)
    old = pp.where(F.col("text").isNotNull())
    j = old.join(idx, (old[DOC] == idx[DOC]) & (content_hash(old["text"]) == idx["_h"])
                 & (old["text"] == idx["_t"]), "left")
    flagged = j.select(old[DOC], old["pos"], old["text"], idx["_n"].isNull().alias("deleted"))
    w = Window.partitionBy(DOC).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    anchored = flagged.withColumn(
        "anchor_pos", F.max(F.when(~F.col("deleted"), F.col("pos"))).over(w))
    return (anchored.where("deleted")
            .groupBy(DOC, "anchor_pos")
            .agg(F.min("pos").alias("start_pos"), F.max("pos").alias("end_pos"),
                 F.count(F.lit(1)).alias("n_paras"),
                 F.transform(F.sort_array(F.collect_list(F.struct("pos", "text"))),
                             lambda s: s["text"]).alias("texts")))


def outer_merge_paragraphs(plog: DataFrame, llog: DataFrame) -> DataFrame:
    """J4 on the paragraph logs: full outer on a paragraph's key (its document and number) with a ``_merge`` indicator."""
    p = plog.select(DOC, "k", F.col("key").alias("_pk"), F.col("para").alias("prev_para"))
    c = llog.select(DOC, "k", F.col("key").alias("_ck"), F.col("para").alias("curr_para"))
    merge = (F.when(F.col("_pk").isNull(), "right_only").when(F.col("_ck").isNull(), "left_only").otherwise("both"))
    return p.join(c, [DOC, "k"], "full_outer").select(F.coalesce("_pk", "_ck").alias("key"), "prev_para", "curr_para", merge.alias("_merge"))


def remove_keys(side: DataFrame, found: DataFrame) -> DataFrame:
    """Drop from ``side`` the paragraph keys (document and number) listed in ``found``."""
    return side.join(found.select(DOC, "k"), [DOC, "k"], "left_anti")
