"""Operator 3: licence scans by canonical digest lookup."""

from __future__ import annotations

from collections.abc import Sequence
from importlib.resources import files

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: notices and short licence texts, as published --------------
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""
_MIT, _ISC = (" ".join(x.split()) for x in (_MIT, _ISC))
# Whole texts as published, in files named by licence; on one line too, where notices inside them are no lines of their own.
_WHOLE = sorted((f.name.removesuffix(".txt"), f.read_text("utf-8")) for f in files(__package__).joinpath("licenses").iterdir() if f.name.endswith(".txt"))
KNOWN_LICENSES = (
    ("MIT", _MIT),
    ("MIT", "MIT License\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n" + _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("ISC", _ISC),
    ("ISC", "ISC License\n" + _ISC),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under CC BY 4.0."),
    *_WHOLE,
    *((name, " ".join(text.split())) for name, text in _WHOLE),
)
# Spellings that count as equal, applied to lower-case text in this order.
SPELLINGS = (
    ("licence", "license"), ("sub-license", "sublicense"), ("sub license", "sublicense"), ("non-commercial", "noncommercial"),
    ("noncommercially", "noncommercial"), ("acknowledgement", "acknowledgment"), ("copyright owner", "copyright holder"),
    ("per cent", "percent"), ("organisation", "organization"), ("whilst", "while"), ("favour", "favor"),
    ("fulfil ", "fulfill "), ("http://", "https://"),
)
# Words that follow "copyright" in sentences of licences, where it is no notice.
SENTENCE = ("act", "acts", "and", "are", "as", "assignment", "claim", "claims", "disclaimer", "disclaimers", "doctrine", "doctrines", "for", "has",
            "holder", "holders", "if", "in", "infringement", "interest", "interests", "is", "law", "laws", "legend", "legends", "licence", "licences",
            "license", "licensed", "licenses", "management", "message", "notice", "notices", "of", "on", "or", "owner", "owners", "ownership",
            "permission", "permissions", "protected", "protection", "right", "rights", "statement", "statements", "status", "term", "terms",
            "that", "the", "to", "treaties", "treaty", "under", "which", "with")
# --- end of fixed values ------------------------------------------------------


def _other_than(words: Sequence[str], start: bool = True) -> str:
    """A pattern that matches where a word begins that is none of ``words`` (RE2 has no look-ahead)."""
    heads = sorted({w[0] for w in words if w})
    rest = "".join(c for c in "abcdefghijklmnopqrstuvwxyz" if c not in heads)
    if start or "" in words:  # another letter has to follow
        ways = [f"[{rest}{rest.upper()}0-9\\x{{80}}-\\x{{10FFFF}}]"]
    else:
        ways = [f"[^{''.join(heads)}{''.join(heads).upper()}\\n]", "$"]
    return "(?:" + "|".join(ways + [h + _other_than([w[1:] for w in words if w[:1] == h], False) for h in heads]) + ")"


# A copyright notice: comment signs, then "copyright" and (c), a sign, a year or a holder; or a sign; or (c) and a year.
# A holder is a word that doesn't go on with a sentence; after "the", only authors, contributors, a foundation or a project.
_YEAR = r"(?:19|20)[0-9][0-9]"
_THE = r"the[\x20\t]+(?:[^\x20\t\n]+[\x20\t]+){1,4}(?:authors|contributors|foundation|project)\b"
NOTICE = (r"^[\x20\t/*#;%-]*(?:copyright[\x20\t]+(?:\(c\)|©|" + f"{_YEAR}|{_THE}|{_other_than(SENTENCE)})"
          + r"|copyright(?:\(c\)|©)|©[\x20\t]|\(c\)[\x20\t]+" + _YEAR + r")[^\n]*")
RESERVED = r"^[\x20\t/*#;%-]*all rights reserved\.?[\x20\t]*$"


def canonical(text: Column) -> Column:
    """Canonical form: no copyright lines, lower case, equal spellings, letters and digits in single-spaced words."""
    t = F.regexp_replace(text, r"\r\n?", "\n")
    for line in (NOTICE, RESERVED):
        t = F.regexp_replace(t, "(?imd)" + line, "")
    t = F.regexp_replace(F.lower(t), r"[\x20\t\n]+", " ")
    for a, b in SPELLINGS:
        t = F.replace(t, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(t, r"[^\p{L}\p{N}]+", " "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def scan_licenses(docs: DataFrame, known: Sequence[tuple[str, str]] | DataFrame = KNOWN_LICENSES,
                  doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Whole-text licence lookup: ``doc_id, text, canonical_sha256, license``, one row per row of ``docs``.

    ``license`` is that of the known text with the same canonical digest, else
    null. Null text counts as empty; texts without a letter or digit match
    nothing. Where two licences share one canonical text, the first by name
    counts. A list of known texts is broadcast (the caller holds it in memory);
    a DataFrame is joined as Spark's size check decides.
    """
    small = not isinstance(known, DataFrame)
    k = known_digests(docs.sparkSession.createDataFrame(list(known), "license string, text string") if small else known)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("canonical_sha256", digest(F.col("text")))
    return rows.join(F.broadcast(k) if small else k, "canonical_sha256", "left").select("doc_id", "text", "canonical_sha256", "license")


def known_digests(known: DataFrame) -> DataFrame:
    return (known.select("license", canonical(F.col("text")).alias("c")).where("c <> ''")
            .groupBy(F.sha2(F.col("c").cast("binary"), 256).alias("canonical_sha256")).agg(F.min("license").alias("license")))


def with_license_lines(scanned: DataFrame, known: Sequence[tuple[str, str]] = KNOWN_LICENSES) -> DataFrame:
    """Look up each line of ``text`` as a text of its own, inside the row (no line is shuffled).

    Adds ``license_lines`` (lines that are a known text) and ``line_licenses``
    (their licences, distinct, sorted, joined by ``|``; empty where none).
    ``known`` is the caller's list and becomes a literal in the plan.
    """
    spark = scanned.sparkSession
    pairs = known_digests(spark.createDataFrame(list(known), "license string, text string")).collect()
    names = F.create_map(*[F.lit(x) for p in pairs for x in (p["canonical_sha256"], p["license"])])
    lines = F.transform(F.split("text", r"\r\n?|\n"), lambda x: F.try_element_at(names, digest(x)))
    return (scanned.withColumn("found", F.filter(lines, lambda x: x.isNotNull()))
            .withColumns({"license_lines": F.size("found").cast("long"),
                          "line_licenses": F.array_join(F.array_sort(F.array_distinct("found")), "|")}).drop("found"))


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _canonical_sql(x: str) -> str:
    t = f"regexp_replace({x}, '\\r\\n?', chr(10), 'g')"
    for line in (NOTICE, RESERVED):
        t = f"regexp_replace({t}, {_quote('(?im)' + line)}, '', 'g')"
    t = f"regexp_replace(lower({t}), '[\\x20\\t\\n]+', ' ', 'g')"
    for a, b in SPELLINGS:
        t = f"replace({t}, {_quote(a)}, {_quote(b)})"
    return f"trim(regexp_replace({t}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


ORACLE_SQL = f"""
WITH k(license, text) AS (VALUES {", ".join(f"({_quote(a)}, {_quote(b)})" for a, b in KNOWN_LICENSES)}),
kd AS (SELECT {_canonical_sql("text")} AS c, min(license) AS license FROM k GROUP BY 1),
d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, kd.license FROM
        (SELECT doc_id, unnest(string_split_regex(text, '\\r\\n?|\\n')) AS line FROM d) x JOIN kd ON {_canonical_sql("line")} = kd.c),
a AS (SELECT doc_id, count(*) AS n, string_agg(DISTINCT license, '|' ORDER BY license) AS names FROM l GROUP BY doc_id)
SELECT d.doc_id, sha256({_canonical_sql("d.text")}) AS canonical_sha256, kd.license,
       coalesce(a.n, 0) AS license_lines, coalesce(a.names, '') AS line_licenses
FROM d LEFT JOIN kd ON {_canonical_sql("d.text")} = kd.c LEFT JOIN a USING (doc_id)
"""
