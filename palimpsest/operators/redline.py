"""Redlines and sequence alignment: D9 (paragraph and word form), D11, D16.

Paragraph-level markup is plain SQL. Word-level markup and alignment need
a sequence matcher, so they run as Arrow-batched pandas UDFs on *changed pairs
only* (never on unchanged text), keyed so that Spark partitions the work.
"""

from __future__ import annotations

import difflib
import html as _html
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.functions.markup import defect, escape

DOC = "doc_id"


# --- D9 paragraph form (pure SQL) -------------------------------------------
def paragraph_markup(pairs: DataFrame) -> DataFrame:
    """Markup per paired paragraph: ``<del>old</del><ins>new</ins>`` for changes, the texts escaped."""
    p, c = escape("prev_text"), escape("curr_text")
    markup = (F.when(F.col("status") == "same", p)
              .when(F.col("status") == "inserted", F.concat(F.lit("<ins>"), c, F.lit("</ins>")))
              .when(F.col("status") == "deleted", F.concat(F.lit("<del>"), p, F.lit("</del>")))
              .otherwise(F.concat(F.lit("<del>"), p, F.lit("</del><ins>"), c, F.lit("</ins>"))))
    return pairs.withColumn("markup", markup)


def repaired(rows: DataFrame, markup: str = "redline") -> DataFrame:
    """``rows`` with their markup made readable where one wrapping does it.

    ``outcome`` is ``ok`` (one well-formed element as it stands), ``wrapped``
    (well formed once put in a ``<div>``) or ``dead``; ``defect`` is the
    reason that is left (see :func:`palimpsest.functions.markup.defect`). Dead
    rows keep their markup, for a table of their own. Only markup that isn't
    well formed is read a second time.
    """
    bad = F.col("_defect").isNotNull()
    wrapped = F.concat(F.lit("<div>"), F.coalesce(F.col(markup), F.lit("")), F.lit("</div>"))
    tried = rows.withColumn("_defect", defect(F.col(markup))).withColumn("_wrapped", F.when(bad & (F.col("_defect") != "empty"), wrapped))
    left = F.when(F.col("_wrapped").isNotNull(), defect(F.col("_wrapped"))).when(bad, F.col("_defect"))
    outcome = F.when(~bad, "ok").when(F.col("defect").isNull(), "wrapped").otherwise("dead")
    return (tried.withColumn("defect", left).withColumn("outcome", outcome)
            .withColumn(markup, F.when(F.col("outcome") == "wrapped", F.col("_wrapped")).otherwise(F.col(markup)))
            .drop("_defect", "_wrapped"))


def document_redline(marked: DataFrame, markup: str = "markup") -> DataFrame:
    """Join a document's markup in position order into one text per document.

    The list per document is bounded by that document's own size (a document
    is already one row of the input).
    """
    return (marked.groupBy(DOC)
            .agg(F.sort_array(F.collect_list(F.struct("pos", markup))).alias("_parts"))
            .select(DOC, F.array_join(F.transform("_parts", lambda s: s[markup]), "\n").alias("redline")))


# --- D9 word form (Arrow UDF) -----------------------------------------------
# A token is a word with the whitespace that follows it (leading whitespace of
# the text is its own token), so a text is exactly the concatenation of them.
_WORDS = re.compile(r"^\s+|\S+\s*")


def redline_words(old: str | None, new: str | None) -> str:
    """Word-level redline of two texts with ``<ins>``/``<del>`` (HTML-escaped).

    Common leading / trailing tokens are split off first; the middle is
    aligned with ``SequenceMatcher`` over integer-coded tokens. Removing the
    ``<ins>`` parts and unwrapping ``<del>`` gives the old text back.
    """
    a = _WORDS.findall(old or "")
    b = _WORDS.findall(new or "")
    lo = 0
    while lo < len(a) and lo < len(b) and a[lo] == b[lo]:
        lo += 1
    ha, hb = len(a), len(b)
    while ha > lo and hb > lo and a[ha - 1] == b[hb - 1]:
        ha -= 1
        hb -= 1
    codes: dict[str, int] = {}
    ca = [codes.setdefault(t, len(codes)) for t in a[lo:ha]]
    cb = [codes.setdefault(t, len(codes)) for t in b[lo:hb]]
    esc = lambda toks: _html.escape("".join(toks), quote=False)
    out = [esc(a[:lo])]
    sm = difflib.SequenceMatcher(None, ca, cb, autojunk=False)
    for op, i1, i2, j1, j2 in sm.get_opcodes():
        if op == "equal":
            out.append(esc(a[lo + i1:lo + i2]))
            continue
        if i2 > i1:
            out.append("<del>" + esc(a[lo + i1:lo + i2]) + "</del>")
        if j2 > j1:
            out.append("<ins>" + esc(b[lo + j1:lo + j2]) + "</ins>")
    out.append(esc(a[ha:]))
    return "".join(out)


@F.pandas_udf(T.StringType())
def word_redline_udf(old: pd.Series, new: pd.Series) -> pd.Series:
    return pd.Series([redline_words(o, n) for o, n in zip(old, new)])


def word_markup(pairs: DataFrame) -> DataFrame:
    """D9 word form on changed pairs; other statuses get the SQL markup.

    Spark evaluates the function for every row; rows of another status hand
    it nothing.
    """
    base = paragraph_markup(pairs)
    changed = F.col("status") == "changed"
    marked = word_redline_udf(F.when(changed, F.col("prev_text")), F.when(changed, F.col("curr_text")))
    return base.withColumn("markup", F.when(changed, marked).otherwise(F.col("markup")))


def strip_redline(c):
    """Invariant helper: remove ``<ins>…</ins>`` and unwrap ``<del>`` -> the old text."""
    col = F.col(c) if isinstance(c, str) else c
    no_ins = F.regexp_replace(col, r"(?s)<ins>.*?</ins>", "")
    return F.regexp_replace(no_ins, r"</?del>", "")


# --- D11 clean underlined text ----------------------------------------------
def clean_underlined(markup) -> Column:
    """Drop ``&lt;``, ``&gt;``, ``<``, ``>`` inside every ``<u>…</u>`` element.

    Every part before a ``</u>`` is cleaned from its first ``<u>`` on; what
    follows the last ``</u>`` stays.
    """
    col = F.col(markup) if isinstance(markup, str) else markup
    parts = F.split(col, "</u>", -1)

    def clean(part, i):
        inner = F.substring(part, F.instr(part, "<u>") + 3, F.length(part))
        for mark in ("&lt;", "&gt;", "<", ">"):
            inner = F.replace(inner, F.lit(mark), F.lit(""))
        closed = (i < F.size(parts) - 1) & F.contains(part, F.lit("<u>"))
        return F.when(closed, F.concat(F.substring_index(part, "<u>", 1), F.lit("<u>"), inner)).otherwise(part)
    return F.array_join(F.transform(parts, clean), "</u>")


# --- D16 paragraph alignment (cogrouped pandas) ------------------------------
ALIGN_SCHEMA = ("doc_id long, prev_pos int, curr_pos int, prev_text string, "
                "curr_text string, status string")


def align_lists(doc_id: int, old: list[str], new: list[str]) -> list[tuple]:
    """Alignment by matching blocks of two paragraph lists with separate offsets on each side."""
    sm = difflib.SequenceMatcher(None, old, new, autojunk=False)
    rows = []
    for op, i1, i2, j1, j2 in sm.get_opcodes():
        if op == "equal":
            rows += [(doc_id, i, j, old[i], new[j], "same") for i, j in zip(range(i1, i2), range(j1, j2))]
        elif op == "replace":
            n = max(i2 - i1, j2 - j1)
            for t in range(n):
                i, j = i1 + t, j1 + t
                rows.append((doc_id, i if i < i2 else None, j if j < j2 else None,
                             old[i] if i < i2 else None, new[j] if j < j2 else None,
                             "changed" if i < i2 and j < j2 else ("deleted" if i < i2 else "inserted")))
        elif op == "delete":
            rows += [(doc_id, i, None, old[i], None, "deleted") for i in range(i1, i2)]
        else:
            rows += [(doc_id, None, j, None, new[j], "inserted") for j in range(j1, j2)]
    return rows


def _align_group(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    doc_id = int(key[0])
    old = left.sort_values("pos")["text"].tolist()
    new = right.sort_values("pos")["text"].tolist()
    rows = align_lists(doc_id, old, new)
    return pd.DataFrame(rows, columns=["doc_id", "prev_pos", "curr_pos", "prev_text", "curr_text", "status"])


def align_paragraphs(pp: DataFrame, lp: DataFrame) -> DataFrame:
    """Per-document alignment by matching blocks (same / changed / inserted / deleted).

    ``cogroup`` hashes both paragraph tables on ``doc_id``; each group is one
    document pair, whose size is bounded by those two input rows.
    """
    # Fresh aliases: both sides may come from one scan and would otherwise
    # share the grouping attribute.
    side = lambda df: df.select(F.col(DOC).alias(DOC), F.col("pos").alias("pos"),
                                F.col("text").alias("text"))
    return (side(pp).groupBy(DOC).cogroup(side(lp).groupBy(DOC))
            .applyInPandas(_align_group, ALIGN_SCHEMA))


_ALIGN_ITEM = T.StructType([
    T.StructField("prev_pos", T.IntegerType()), T.StructField("curr_pos", T.IntegerType()),
    T.StructField("prev_text", T.StringType()), T.StructField("curr_text", T.StringType()),
    T.StructField("status", T.StringType())])


@F.pandas_udf(T.ArrayType(_ALIGN_ITEM))
def _align_udf(old: pd.Series, new: pd.Series) -> pd.Series:
    out = []
    for o, n in zip(old, new):
        rows = align_lists(0, list(o), list(n))
        out.append([{"prev_pos": r[1], "curr_pos": r[2], "prev_text": r[3], "curr_text": r[4],
                     "status": r[5]} for r in rows])
    return pd.Series(out)


_align_udf = _align_udf.asNondeterministic()


def align_documents(pairs: DataFrame) -> DataFrame:
    """D16 on joined document pairs ``(doc_id, prev_text, curr_text)``.

    The two snapshots already meet in one row (one exchange per side for the
    join); the paragraph arrays are split and trimmed in Spark, aligned by the
    sequence matcher in Arrow batches, and exploded back to rows. No cogroup
    shuffle and no per-document pandas frame.
    """
    from palimpsest.operators.paragraphs import paragraph_array
    aligned = pairs.select(DOC, F.explode(_align_udf(paragraph_array("prev_text"),
                                                     paragraph_array("curr_text"))).alias("_a"))
    return aligned.select(DOC, "_a.prev_pos", "_a.curr_pos", "_a.prev_text", "_a.curr_text", "_a.status")
