"""XML sources: chapter documents (S3), crawl reports (S4), ill-formed input.

Schemas are always explicit: inference turns attribute values into
timestamps and flips ``document`` between struct and array by row count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.constants import NOT_FOUND
from palimpsest.functions import markup

# --- S3 chapter documents -----------------------------------------------------
# Elements as they stand in canonical markup (functions.markup.canonical), whose tags are bare.
CHAPTER = r"(?s)<ci:content>(.*?)</ci:content>"
HEADING = r"(?s)<docinfo:doc-heading>(.*?)</docinfo:doc-heading>"
SOURCE = r"(?s)<docinfo:hierlev>.*?<docinfo:hierlev>.*?<title>(.*?)</title>"  # of the second level
# a <text> or <h> element with all that it holds; the self-closing form holds nothing
ELEMENT = r"(?s)<(text|h)(?:/>|>(.*?)</\1>)"


def documents_to_xml(snapshot: DataFrame, element=None) -> DataFrame:
    """Render snapshot rows as chapter XML documents ``(doc_id, xml)``.

    Used to land a snapshot as files and by the S3 round-trip query; every
    paragraph becomes a ``<text>`` element in order, or what ``element(text,
    position)`` makes of it.
    """
    esc = markup.escape
    write = element or (lambda p, i: F.concat(F.lit("<text>"), esc(p), F.lit("</text>")))
    paras = F.transform(F.split("text", "\n"), write)
    xml = F.concat(
        F.lit('<doc xmlns:ci="urn:ci" xmlns:docinfo="urn:docinfo"><ci:content>'), esc("chapter"),
        F.lit("</ci:content><docinfo:doc-heading>"), esc(F.concat_ws(" ", "chapter", "title")),
        F.lit("</docinfo:doc-heading><docinfo:hierlev><docinfo:hierlev><title>"), esc("manual"),
        F.lit("</title></docinfo:hierlev></docinfo:hierlev><body>"), F.array_join(paras, ""),
        F.lit("</body></doc>"))
    return snapshot.select("doc_id", xml.alias("xml"))


def element_value(inner) -> Column:
    """String value of an element's inside in canonical markup: tags dropped, entities decoded."""
    return markup.decode_entities(F.regexp_replace(inner, r"<[^>]*>", ""))


def xml_elements(df: DataFrame, xml: str = "xml") -> DataFrame:
    """``(..., pos, tag, text)`` of every ``<text>`` and ``<h>`` element in document order.

    ``text`` is the element's whole string value: nested inline elements and
    CDATA sections count, comments and instructions don't, and named, decimal
    and hexadecimal entities are decoded. An empty element is a row with empty
    text; an element of the two kinds inside one of the other kind is part of
    its value. Markup that isn't well formed gives the elements that can be
    read, a null or empty document no rows.
    """
    keep = [c for c in df.columns if c != xml]
    plain = df.select(*keep, markup.canonical(F.col(xml)).alias("_x"))
    tags = F.regexp_extract_all("_x", F.lit(ELEMENT), F.lit(1))
    inner = F.regexp_extract_all("_x", F.lit(ELEMENT), F.lit(2))
    rows = F.arrays_zip(tags.alias("tag"), F.transform(inner, element_value).alias("text"))
    return (plain.select(*keep, F.posexplode(rows).alias("pos", "_e"))
            .select(*keep, "pos", F.col("_e.tag").alias("tag"), F.col("_e.text").alias("text")))


def parse_xml_documents(df: DataFrame, xml: str = "xml") -> DataFrame:
    """S3 + P1: chapter, title (chapter prefix removed), source and paragraphs.

    The document is cut into tokens once (:func:`palimpsest.functions.markup.canonical`)
    and the fields are read from its canonical form, the text from its
    ``<text>`` and ``<h>`` elements as in :func:`xml_elements`. Missing fields
    default to ``not found``; so do all fields of a document that isn't well
    formed, whose ``defect`` says why and whose text is NULL.
    """
    keep = [c for c in df.columns if c != xml]
    plain = df.select(*keep, markup.defect(F.col(xml)).alias("defect"), markup.canonical(F.col(xml)).alias("_c"))
    plain = plain.withColumn("_x", F.when(F.col("defect").isNull(), F.col("_c")))
    field = lambda pattern: F.nullif(element_value(F.regexp_extract("_x", pattern, 1)), F.lit(""))
    chapter, heading, source = field(CHAPTER), field(HEADING), field(SOURCE)
    title = F.replace(heading, F.concat(F.coalesce(chapter, F.lit("")), F.lit(" ")), F.lit(""))
    paras = F.transform(F.regexp_extract_all("_x", F.lit(ELEMENT), F.lit(2)), element_value)
    return plain.select(*keep,
                        F.coalesce(chapter, F.lit(NOT_FOUND)).alias("chapter"),
                        F.coalesce(title, F.lit(NOT_FOUND)).alias("title"),
                        F.coalesce(source, F.lit(NOT_FOUND)).alias("manual"),
                        F.array_join(paras, "\n").alias("text"), "defect")


def read_xml_documents(spark: SparkSession, path: str) -> DataFrame:
    """S3 + F6: scan ``*.xml`` files whole and parse them."""
    df = (spark.read.option("wholetext", True).option("pathGlobFilter", "*xml*")
          .option("recursiveFileLookup", True).text(path))
    return parse_xml_documents(df.select(F.col("_metadata.file_name").alias("file_name"),
                                         F.col("value").alias("xml")))


# --- S4 crawl reports -----------------------------------------------------------
_DOC = T.StructType([T.StructField("_id", T.StringType()), T.StructField("_title", T.StringType()),
                     T.StructField("_uri", T.StringType())])
_SECTION = T.StructType([T.StructField("document", T.ArrayType(_DOC))])
CRAWL_REPORT_SCHEMA = T.StructType([
    T.StructField("added", _SECTION), T.StructField("changed", _SECTION), T.StructField("removed", _SECTION),
    T.StructField("_corrupt_record", T.StringType()),
])
SECTION_TYPES = [("added", "new"), ("changed", "change"), ("removed", "deletion")]
REPORT_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", "ignoreSurroundingSpaces": "false"}


def read_crawl_reports(spark: SparkSession, path: str) -> DataFrame:
    """Crawl report files (``<report>`` root) with the explicit schema."""
    return (spark.read.format("xml").option("rowTag", "report").option("mode", "PERMISSIVE")
            .option("ignoreSurroundingSpaces", False)
            .option("columnNameOfCorruptRecord", "_corrupt_record")
            .schema(CRAWL_REPORT_SCHEMA).load(path)
            .withColumn("report_file", F.col("_metadata.file_name")))


def parse_crawl_report_column(df: DataFrame, col: str = "report_xml") -> DataFrame:
    """S4 for reports held in a string column (``from_xml``, PERMISSIVE)."""
    parsed = F.from_xml(F.col(col), CRAWL_REPORT_SCHEMA, REPORT_OPTIONS)
    keep = [c for c in df.columns if c != col]
    return df.select(*keep, parsed.alias("_r")).select(*keep, "_r.*")


def report_documents(report=None) -> Column:
    """All documents of a parsed report as one array of ``update_type, id, title, uri``.

    ``report`` names the struct column that holds the parsed report; without
    it its sections are columns. An empty section has no documents (P5).
    """
    none = F.array().cast(T.ArrayType(_DOC))

    def rows(section: str, update_type: str):
        docs = F.col(f"{report}.{section}.document" if report else f"{section}.document")
        return F.transform(F.coalesce(docs, none), lambda d: F.struct(
            F.lit(update_type).alias("update_type"), d["_id"].alias("id"), d["_title"].alias("title"), d["_uri"].alias("uri")))
    return F.concat(*[rows(section, update_type) for section, update_type in SECTION_TYPES])


def explode_crawl_report(reports: DataFrame) -> DataFrame:
    """``(update_type, id, title, uri)`` rows, one per ``document``.

    The sections become one array of typed rows, exploded once, so that the
    report is parsed once.
    """
    keep = [c for c in reports.columns if c not in ("added", "changed", "removed", "_corrupt_record")]
    return reports.where(F.col("_corrupt_record").isNull()).select(*keep, F.inline(report_documents()))


def split_bad_records(reports: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, ill-formed rows) — bad input is a side output, not a crash.

    Spark rejects a query on a raw file scan that reads *only* the corrupt
    record column; read it together with the parsed columns (or persist first).
    """
    bad = F.col("_corrupt_record").isNotNull()
    return reports.where(~bad), reports.where(bad)


def document_report_xml(status: DataFrame) -> DataFrame:
    """Render one crawl-report ``<report>`` per changed document (bounded size).

    ``status`` has ``doc_id, update_type, chapter, title, manual``; used to
    land reports as files for the streaming job and by the S4 query.
    """
    section = (F.when(F.col("update_type") == "new", "added")
               .when(F.col("update_type") == "change", "changed").otherwise("removed"))
    uri = F.concat(F.lit("https://manuals.example.org/"), F.col("manual"), F.lit("/"), F.lower("chapter"))
    doc = F.concat(F.lit('<document id="'), F.col("doc_id").cast("string"), F.lit('" title="'),
                   markup.escape(F.replace("title", F.lit('"'), F.lit("'"))), F.lit('" uri="'), uri, F.lit('"/>'))
    body = F.concat(F.lit("<"), section, F.lit(">"), doc, F.lit("</"), section, F.lit(">"))
    return status.select("doc_id", F.concat(F.lit("<report>"), body, F.lit("</report>")).alias("report_xml"))
