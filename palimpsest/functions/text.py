"""Column expressions over text: distance, length, trimming, flags, regex.

Everything here returns a ``Column`` built from Spark SQL built-ins, so it runs
inside whole-stage codegen; nothing calls back into Python.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from palimpsest.constants import (
    CHAPTER_FOLDER,
    LEVCHAR_LENGTH_LIMIT,
    LEVCHAR_MARGIN,
    NOISE_MARKERS,
    SIGNIFICANCE_THRESHOLD,
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- D2 length difference --------------------------------------------------
def length_diff(a, b) -> Column:
    """Absolute difference of code-point lengths."""
    return F.abs(F.length(_col(a)) - F.length(_col(b)))


# --- D1 edit distance -------------------------------------------------------
def edit_distance(a, b) -> Column:
    """Exact Levenshtein distance on code points, JVM side (short text).

    The jobs go through :func:`palimpsest.functions.distance.long_edit_distance`
    instead: the built-in fills the full matrix cell by cell.
    """
    return F.levenshtein(_col(a), _col(b))


def exceeds_distance(a, b, limit: int = SIGNIFICANCE_THRESHOLD) -> Column:
    """``edit_distance(a, b) > limit`` without computing the full distance.

    A length difference above the limit decides it at once; otherwise the
    banded form answers -1 exactly when the distance is above the limit.
    """
    a, b = _col(a), _col(b)
    return F.when(length_diff(a, b) > limit, F.lit(True)).otherwise(
        F.levenshtein(a, b, limit) == -1)


# --- D3 trim ----------------------------------------------------------------
def trim_trailing_blank(c) -> Column:
    """Remove one trailing whitespace character (``'a  '`` -> ``'a '``).

    ``(?U)`` makes ``\\s`` Unicode-aware so a trailing NBSP goes too.
    """
    return F.regexp_replace(_col(c), r"(?U)\s\z", "")


# --- F11 text changed -------------------------------------------------------
def text_changed(prev, curr) -> Column:
    """True when ``prev`` is non-empty, ``curr`` present, and they differ.

    A missing previous value reads as the text ``'nan'`` and so counts as a
    change; a missing current value never does; an empty previous never does.
    """
    p = F.coalesce(_col(prev), F.lit("nan"))
    c = _col(curr)
    return (p != F.lit("")) & c.isNotNull() & (p != c)


def any_changed(pairs) -> Column:
    """OR of :func:`text_changed` over ``[(prev, curr), ...]`` (chapter, title, para)."""
    return reduce(lambda x, y: x | y, [text_changed(p, c) for p, c in pairs])


# --- F12 distance / length rule --------------------------------------------
def levchar_flag(lev, char_diff) -> Column:
    """If the length difference is below 10, require distance > diff + 10."""
    cd = _col(char_diff)
    return F.when(cd < LEVCHAR_LENGTH_LIMIT, _col(lev) > cd + LEVCHAR_MARGIN).otherwise(F.lit(True))


# --- F2 significance --------------------------------------------------------
def significant(lev_distance, para_change_count) -> Column:
    return (_col(para_change_count) != 0) & (_col(lev_distance) > SIGNIFICANCE_THRESHOLD)


# --- F4 paragraph noise -----------------------------------------------------
def is_kept_paragraph(p) -> Column:
    """Keep paragraphs longer than one character without a noise marker."""
    p = _col(p)
    cond = F.length(p) > 1
    for marker in NOISE_MARKERS:
        cond = cond & ~p.contains(marker)
    return cond


# --- F9 phrase test ---------------------------------------------------------
def contains_any(c, phrases) -> Column:
    c = _col(c)
    return reduce(lambda x, y: x | y, [c.contains(p) for p in phrases])


# --- D5 regex extraction ----------------------------------------------------
def leading_prefix(c) -> Column:
    """Leading non-digit part of a chapter number (``ABC123`` -> ``ABC``)."""
    return F.regexp_extract(_col(c), r"^[^0-9]+", 0)


def extract_or_null(c, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(_col(c), pattern, group), F.lit(""))


# --- D6 regex clean chain ---------------------------------------------------
def replace_chain(c, rules) -> Column:
    """Fold ``[(pattern, replacement), ...]`` into nested ``regexp_replace``."""
    return reduce(lambda acc, r: F.regexp_replace(acc, r[0], r[1]), rules, _col(c))


# --- D7 case ----------------------------------------------------------------
def title_case_words(c) -> Column:
    """``replace('-', ' ')`` then capitalise each blank-separated word."""
    return F.initcap(F.replace(_col(c), F.lit("-"), F.lit(" ")))


# --- D8 whitespace squeeze --------------------------------------------------
def squeeze_blank_runs(c) -> Column:
    """Remove runs of two or more whitespace characters."""
    return F.regexp_replace(_col(c), r"\s\s+", "")


# --- A6 literal occurrences -------------------------------------------------
def count_literal(text, term) -> Column:
    """Non-overlapping, left-to-right occurrences of a literal term."""
    t, s = _col(text), _col(term)
    return ((F.length(t) - F.length(F.replace(t, s, F.lit("")))) / F.length(s)).cast("long")


# --- D15 list to text -------------------------------------------------------
def list_to_text(c, sep: str = ", ") -> Column:
    return F.array_join(_col(c), sep)


# --- hashing (F1b, J8) ------------------------------------------------------
def content_hash(c) -> Column:
    """64-bit content fingerprint used as a narrow join / comparison key."""
    return F.xxhash64(_col(c))


def link_to(target, around: tuple[str, str]) -> Column:
    """A published link to ``target``, between the two fixed parts ``around``."""
    return F.concat(F.lit(around[0]), _col(target), F.lit(around[1]))


def chapter_link(chapter, suffix: str, around: tuple[str, str]) -> Column:
    """A published link to one of a chapter's files."""
    return link_to(F.concat(F.lit(CHAPTER_FOLDER), _col(chapter), F.lit(suffix)), around)
