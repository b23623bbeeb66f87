"""Column expressions over HTML / XML markup (regex based, JVM side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from palimpsest.functions.text import _col, replace_chain

# --- fixed values -----------------------------------------------------------
# Redline clean-up rules applied after word-level markup (D6), in order.
REDLINE_CLEAN_RULES = [
    (r"<br>", "<br/>"),
    (r"<hr>", "<hr/>"),
    (r"&lt;", "<"),
    (r"&gt;", ">"),
    (r"<ul><li></ul>", ""),
    (r"<u>", ""),
    (r"</u>", ""),
    (r"<img ([^>]*)>", "<img $1 />"),
    (r"”", '"'),
    (r"<span [^>]*>", "<span>"),
    (r"<span>", ""),
    (r"</span>", ""),
]
# HTML entities decoded by text rendering.
ENTITY_RULES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]
# --- end of fixed values ----------------------------------------------------


def strip_navigation(html) -> Column:
    """Drop every ``<nav>…</nav>`` element."""
    return F.regexp_replace(_col(html), r"(?is)<nav\b.*?</nav>", "")


def article_body(html) -> Column:
    """M9: inner markup of the first ``<article>`` element ('' when absent)."""
    return F.regexp_extract(_col(html), r"(?is)<article>(.*?)</article>", 1)


def unescape_entities(c) -> Column:
    out = _col(c)
    for ent, ch in ENTITY_RULES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    return out


def html_to_text(html) -> Column:
    """Text rendering — script/style removed, tags removed, entities decoded."""
    no_code = F.regexp_replace(_col(html), r"(?is)<(script|style)\b.*?</\1>", "")
    no_tags = F.regexp_replace(no_code, r"(?s)<[^>]*>", "")
    return unescape_entities(no_tags)


def element_texts(html, tag: str = "p") -> Column:
    """Inner markup of every ``<tag>…</tag>`` element, in document order."""
    return F.regexp_extract_all(_col(html), F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>"), F.lit(1))


def clean_redline(c) -> Column:
    """The ordered clean-up chain applied to redline markup."""
    return replace_chain(c, REDLINE_CLEAN_RULES)


def url_part(url, n: int) -> Column:
    """N-th path segment (1-based) of an absolute URL, NULL when absent."""
    pattern = r"^[A-Za-z]+://[^/]+" + r"/([^/?#]*)" * n
    return F.nullif(F.regexp_extract(_col(url), pattern, n), F.lit(""))
