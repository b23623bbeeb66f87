"""Markup read token by token in columns: validity, canonical form, entities, stray brackets.

A text is cut into tokens once, by one pattern whose alternatives never
overlap (comments, CDATA sections, instructions, tags with quoted attributes,
character data, a ``<`` that begins none of these). Everything else is a
function of the token array, inside the row: no exchange, linear in the text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from palimpsest.functions.text import _col

_NAME = r"[A-Za-z_:][-\w:.]*"
_ATTRIBUTE = r"""\s+[A-Za-z_:][-\w:.]*\s*=\s*(?:"[^"<]*"|'[^'<]*')"""
TAG = rf"</?{_NAME}(?:{_ATTRIBUTE})*\s*/?>"
TOKEN = rf"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|<!DOCTYPE[^>]*>|{TAG}|[^<]+|<"
ENTITY = r"&(?:#[0-9]+|#x[0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);"
# --- fixed values -----------------------------------------------------------
NAMED_ENTITIES = {"lt": "<", "gt": ">", "amp": "&", "quot": '"', "apos": "'"}
# Elements of running text and tables that a redline may hold.
KNOWN_TAGS = ["a", "abbr", "article", "b", "blockquote", "br", "caption", "code", "dd", "del", "div", "dl", "dt", "em", "h1", "h2", "h3",
              "h4", "h5", "h6", "hr", "i", "img", "ins", "li", "ol", "p", "pre", "section", "small", "span", "strong", "sub", "sup",
              "table", "tbody", "td", "tfoot", "th", "thead", "tr", "u", "ul"]
# --- end of fixed values ----------------------------------------------------


def escape(c) -> Column:
    """``&``, ``<`` and ``>`` as entities."""
    return F.replace(F.replace(F.replace(_col(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def tokens(c) -> Column:
    """The tokens of a text; joined they are the text."""
    return F.regexp_extract_all(_col(c), F.lit(TOKEN), F.lit(0))


def canonical(c) -> Column:
    """The same content in plain markup: bare tags, no comments or instructions, CDATA as escaped text, stray ``<`` escaped."""
    def plain(t: Column) -> Column:
        return (F.when(~t.startswith("<"), t)
                .when(t.startswith("<![CDATA["), escape(F.substring(t, F.lit(10), F.length(t) - 12)))
                .when(t.startswith("<!") | t.startswith("<?"), F.lit(""))
                .when(t == "<", F.lit("&lt;"))
                .otherwise(F.regexp_replace(t, rf"(?s)^(</?{_NAME}).*?(/?)>\z", "$1$2>")))
    return F.array_join(F.transform(tokens(c), plain), "")


def decode_entities(c) -> Column:
    """Named (XML's five), decimal and hexadecimal entities decoded once; other text stays, unknown entities too."""
    c = _col(c)

    def char(hexa: Column) -> Column:
        code = F.lpad(hexa, 8, "0")
        valid = (F.length(hexa) <= 8) & (code <= "0010FFFF") & ~code.between("0000D800", "0000DFFF") & (code != "00000000")
        return F.when(valid, F.decode(F.unhex(code), "UTF-32"))

    def decoded(t: Column) -> Column:
        out = F.when(t.startswith("&#x"), char(F.upper(F.substring(t, F.lit(4), F.length(t) - 4))))
        out = out.when(t.startswith("&#"), char(F.conv(F.substring(t, F.lit(3), F.length(t) - 3), 10, 16)))
        for name, value in NAMED_ENTITIES.items():
            out = out.when(t == f"&{name};", F.lit(value))
        return F.coalesce(out, t)
    parts = F.regexp_extract_all(c, F.lit(rf"{ENTITY}|[^&]+|&"), F.lit(0))
    return F.when(F.contains(c, F.lit("&")), F.array_join(F.transform(parts, decoded), "")).otherwise(c)


def defect(c) -> Column:
    """Why a text isn't one well-formed element, or NULL: ``empty``, ``stray bracket``, ``bare ampersand``,
    ``unbalanced tags``, ``several roots`` (text beside the root counts as one).

    A fold over the tags keeps the names that are open, so its work is the
    number of tags times their depth.
    """
    c = _col(c)
    content = F.filter(tokens(c), lambda t: ~(t.startswith("<!--") | t.startswith("<?") | t.startswith("<!DOCTYPE")))
    none = F.array().cast("array<string>")
    state = F.struct(none.alias("open"), F.lit(0).alias("roots"), F.lit(False).alias("bad"))

    def step(s: Column, t: Column) -> Column:
        depth = F.size(s["open"])
        name = F.regexp_extract(t, rf"^</?({_NAME})", 1)
        is_tag = (name != "") & t.endswith(">")
        closes = is_tag & t.startswith("</")
        empty = is_tag & t.endswith("/>")
        opens = is_tag & ~closes & ~empty
        new_root = (depth == 0) & ~closes & (is_tag | (F.trim(F.translate(t, "\t\r\n", "   ")) != ""))
        matches = F.try_element_at(s["open"], F.lit(1)) == name
        return F.struct(
            F.when(opens, F.concat(F.array(name), s["open"]))
            .when(closes & (depth > 0), F.slice(s["open"], F.lit(2), F.greatest(depth - 1, F.lit(0)))).otherwise(s["open"]).alias("open"),
            (s["roots"] + F.when(new_root, F.when(is_tag, 1).otherwise(2)).otherwise(0)).alias("roots"),
            (s["bad"] | (closes & ~F.coalesce(matches, F.lit(False)))).alias("bad"))
    end = F.aggregate(content, state, step)
    text = F.filter(content, lambda t: ~t.startswith("<"))
    bare = F.exists(text, lambda t: t.rlike(rf"&(?!(?:#[0-9]+|#x[0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);)"))
    return (F.when(c.isNull() | (F.trim(F.translate(c, "\t\r\n", "   ")) == ""), "empty")
            .when(F.array_contains(content, "<"), "stray bracket").when(bare, "bare ampersand")
            .when(end["bad"] | (F.size(end["open"]) > 0), "unbalanced tags")
            .when(end["roots"] != 1, "several roots"))


def strip_stray_brackets(c, known: list[str] | None = None) -> Column:
    """Brackets that belong to no tag of ``known`` go, what stands between them stays.

    The text is cut before each ``<``; a piece that begins with a known tag
    keeps that tag, and loses any other ``<`` and ``>``.
    """
    c = _col(c)
    tag = rf"""(?is)^(<\/?(?:{'|'.join(known or KNOWN_TAGS)})(?:\s(?:"[^"]*"|'[^']*'|[^<>"']++)*+)?\/?>)(.*)\z"""

    def piece(p: Column) -> Column:
        head = F.regexp_extract(p, tag, 1)
        return F.concat(head, F.translate(F.when(head != "", F.regexp_extract(p, tag, 2)).otherwise(p), "<>", ""))
    return F.array_join(F.transform(F.split(c, "(?=<)"), piece), "")


def close_void(c) -> Column:
    """Tags of elements that hold nothing (``br``, ``hr``, ``img``) written as closed ones."""
    return F.regexp_replace(_col(c), r"(?i)<(br|hr|img)\b([^<>]*?)\s*/?>", "<$1$2/>")
