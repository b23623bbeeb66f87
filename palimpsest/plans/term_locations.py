"""Term-location job: archive members -> group lookup -> text -> term hits ->
path parts -> reference-locations table.

Its output ``(doc_ref, grp, filename, area, term, n_hits, running_hits)`` is
the reference table that the relevance lookups (A2, J7, J9) read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.constants import NOT_FOUND
from palimpsest.functions.markup import canonical
from palimpsest.operators import search
from palimpsest.sources.xml import element_value


def member_paths(docs: DataFrame) -> DataFrame:
    """Archive member path of each document: ``<manual>/<LANG>_ch_<doc_id>.xml``."""
    return docs.select("doc_id", "text", F.concat(
        F.col("source"), F.lit("/"), F.upper("lang"), F.lit("_ch_"), F.col("doc_id").cast("string"),
        F.lit(".xml")).alias("member"))


def locations(members: DataFrame, groups: DataFrame | None, terms: DataFrame) -> DataFrame:
    """J13 -> J14/A6/W4 -> D5 over members ``(doc_id, member, text)``."""
    parsed = members.select("doc_id", "member", "text", *search.parse_member_path("member"))
    if groups is not None:
        parsed = search.members_in_groups(parsed, groups)
    hits = search.term_hits(parsed.select("doc_id", "text"), terms)
    meta = parsed.select("doc_id", "grp", "filename", "doc_ref", "area")
    return hits.join(meta, "doc_id")


TITLE = r"(?s)<kh:document-title>(.*?)</kh:document-title>"


def records(members: DataFrame, groups: DataFrame, terms: DataFrame) -> DataFrame:
    """Term records of XML archive members: ``doc_ref, doc_title, area, filename, pattern, count``.

    ``members``: ``doc_id, member, xml``. Only members of the looked-up groups
    are read (J13); the markup is cut into tokens once for the title and the
    whole text (D12), in which terms are found (J14). ``count`` runs on over a
    member's terms in list order (W4). Parts that are missing read ``not found`` (P1).
    """
    parts = members.select("doc_id", "member", "xml", *search.parse_member_path("member"))
    plain = (search.members_in_groups(parts.where(F.col("member").contains("xml")), groups)
             .withColumn("_x", canonical(F.col("xml"))).withColumn("text", element_value(F.col("_x"))))
    hits = search.term_hits(plain.select("doc_id", "text"), terms)
    title = F.nullif(element_value(F.regexp_extract("_x", TITLE, 1)), F.lit(""))
    or_not = lambda c: F.coalesce(c, F.lit(NOT_FOUND))
    return hits.join(plain.select("doc_id", title.alias("doc_title"), "doc_ref", "area", "filename"), "doc_id").select(
        or_not("doc_ref").alias("doc_ref"), or_not("doc_title").alias("doc_title"), or_not("area").alias("area"),
        or_not("filename").alias("filename"), F.col("term").alias("pattern"), F.col("running_hits").alias("count"))
