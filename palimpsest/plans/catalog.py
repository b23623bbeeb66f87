"""Registry of the engine's queries: name -> (Spark builder, DuckDB oracle SQL).

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
given tables (whole tables, whole texts). The oracle SQL recomputes the same
result independently in DuckDB over the same parquet views; ``None`` marks
operators that SQL cannot express (Arrow UDFs, sequence alignment) and are
checked against brute force in the tests instead.

Column names and types are aligned between the two sides: counts are BIGINT,
positions INTEGER.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.constants import SIGNIFICANCE_THRESHOLD
from palimpsest.functions import html as H
from palimpsest.functions import markup
from palimpsest.functions import text as X
from palimpsest.functions.distance import far_apart, long_edit_distance
from palimpsest.operators import feed, paragraphs, redline, relevance, report, scoring, search, snapshot
from palimpsest.plans import daily_jobs, document_changes, paragraph_changes, term_locations
from palimpsest.session import configure, ship_package
from palimpsest.plans.oracle import LOG_CTES, PARAGRAPH_CTES, SNAPSHOT_CTES, cp, lev, with_ctes
from palimpsest.sources import csv_lists, xml
from palimpsest.sources.snapshots import snapshot_listing, snapshot_pair
from palimpsest.sources.tables import read_pages, read_table
from palimpsest.streaming import change_feed

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}

# Engine parity in the oracle SQL: Spark (like Python) upper-cases 'ß' to 'SS'
# (title case 'Ss'), DuckDB to 'ẞ'; the oracle maps it back.

# The run date of the daily jobs in the registered queries (events cover January 2024).
RUN_DATE = "2024-01-15"


def query(name: str, sql: str | None):
    """Register a builder; the registered callable first applies the engine's
    SQL settings to the session and ships the package to the Python workers
    (both no-ops after the first call in an application)."""
    def deco(fn: Builder) -> Builder:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            ship_package(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        REGISTRY[name] = (run, sql.strip() if sql else None)
        return fn
    return deco


def _pair(spark, sf):
    return snapshot_pair(spark, sf)


def _paras(spark, sf, with_next=False):
    prev, latest = _pair(spark, sf)
    return (paragraphs.explode_paragraphs(prev, with_next=with_next),
            paragraphs.explode_paragraphs(latest, with_next=with_next))


# =============================================================================
# Sources (S1-S7)
# =============================================================================
@query("snapshot_listing", with_ctes(SNAPSHOT_CTES, "SELECT lower(chapter) || '.xml' AS col FROM latest"))
def q_snapshot_listing(spark, sf):
    """The latest snapshot as a one-column listing."""
    return snapshot_listing(_pair(spark, sf)[1])


_TEAM_VALUES = """
teams(team, source) AS (VALUES
  ('alpha', 'src1'), ('alpha', 'src4'), ('alpha', 'src7'),
  ('alpha', 'src10'), ('alpha', 'src13'), ('alpha', 'src16'),
  ('alpha', 'src19'), ('alpha', 'SRC2'),
  ('beta', 'src0'), ('beta', 'src3'), ('beta', 'src4'), ('beta', 'src8'),
  ('gamma', 'src2'), ('gamma', 'src5'), ('gamma', 'src6'), ('gamma', 'src9'), ('gamma', 'src11'), ('gamma', 'src12'),
  ('gamma', 'src14'), ('gamma', 'src15'), ('gamma', 'src17'), ('gamma', 'src18'))"""


@query("team_documents", with_ctes(_TEAM_VALUES, """
SELECT t.team, d.doc_id, d.source FROM documents d JOIN teams t ON d.source = t.source"""))
def q_team_documents(spark, sf):
    """S2 + J11: team lists read from CSV (BOM, quotes) joined to every document."""
    docs = read_table(spark, sf, "documents", ["doc_id", "source"])
    return relevance.team_rows(docs, csv_lists.read_team_lists(spark)).select("team", "doc_id", "source")


def _woven(p, i):
    """How the test documents write a paragraph: headings, comments, CDATA, numeric entities, quoted ``>``, nested elements."""
    esc = markup.escape(p)
    inline = F.regexp_replace(esc, "^([A-Za-z])", '<emph k="a>b">$1</emph>')
    numeric = F.replace(F.replace(esc, F.lit("o"), F.lit("&#111;")), F.lit("n"), F.lit("&#x6E;"))
    cdata = F.replace(p, F.lit("]]>"), F.lit("]]]]><![CDATA[>"))
    return (F.when(p == "", F.lit("<text/>"))
            .when(i % 4 == 0, F.concat(F.lit('<!-- <text>not a row</text> --><h id="a>b">'), inline, F.lit("</h>")))
            .when(i % 4 == 1, F.concat(F.lit("<text><![CDATA["), cdata, F.lit("]]></text>")))
            .when(i % 4 == 2, F.concat(F.lit("<text n='1'>"), numeric, F.lit("</text>")))
            .otherwise(F.concat(F.lit('<text><remotelink href="x">'), esc, F.lit("</remotelink><?skip <h>no</h>?></text>"))))


@query("xml_document_fields", with_ctes(SNAPSHOT_CTES, """
SELECT doc_id, chapter, title, manual, text FROM prev"""))
def q_xml_document_fields(spark, sf):
    """S3 + P1 + D12: fields and text of chapter documents with every kind of markup (``_woven``)."""
    prev = _pair(spark, sf)[0]
    return xml.parse_xml_documents(xml.documents_to_xml(prev, _woven)).select("doc_id", "chapter", "title", "manual", "text")


@query("xml_elements", with_ctes(SNAPSHOT_CTES, """
SELECT doc_id, CAST(u.pos - 1 AS INTEGER) AS pos, CASE WHEN u.t <> '' AND u.pos % 4 = 1 THEN 'h' ELSE 'text' END AS tag, u.t AS text
FROM prev, unnest(string_split(text, chr(10))) WITH ORDINALITY AS u(t, pos)"""))
def q_xml_elements(spark, sf):
    """``h`` and ``text`` rows of chapter documents with every kind of markup (``_woven``)."""
    return xml.xml_elements(xml.documents_to_xml(_pair(spark, sf)[0], _woven))


_STATUS_SQL = """
status AS (SELECT coalesce(p.doc_id, l.doc_id) AS doc_id,
                  CASE WHEN p.doc_id IS NULL THEN 'new' WHEN l.doc_id IS NULL THEN 'deletion'
                       WHEN p.text <> l.text THEN 'change' ELSE 'same' END AS update_type,
                  coalesce(l.chapter, p.chapter) AS chapter, coalesce(l.title, p.title) AS title,
                  coalesce(l.manual, p.manual) AS manual
           FROM prev p FULL OUTER JOIN latest l ON p.doc_id = l.doc_id)"""


def _status(spark, sf):
    prev, latest = _pair(spark, sf)
    p = prev.select("doc_id", F.sha2("text", 256).alias("pt"), F.col("chapter").alias("pc"),
                    F.col("title").alias("pti"), F.col("manual").alias("pm"))
    c = latest.select("doc_id", F.sha2("text", 256).alias("lt"), F.col("chapter").alias("lc"),
                      F.col("title").alias("lti"), F.col("manual").alias("lm"))
    j = p.join(c, "doc_id", "full_outer")
    ut = (F.when(F.col("pt").isNull(), "new").when(F.col("lt").isNull(), "deletion")
          .when(F.col("pt") != F.col("lt"), "change").otherwise("same"))
    return j.select("doc_id", ut.alias("update_type"), F.coalesce("lc", "pc").alias("chapter"),
                    F.coalesce("lti", "pti").alias("title"), F.coalesce("lm", "pm").alias("manual"))


@query("crawl_report_rows", with_ctes(SNAPSHOT_CTES + "," + _STATUS_SQL, """
SELECT doc_id, update_type, CAST(doc_id AS VARCHAR) AS id, replace(title, '"', '''') AS title,
       'https://manuals.example.org/' || manual || '/' || lower(chapter) AS uri
FROM status WHERE update_type <> 'same'"""))
def q_crawl_report_rows(spark, sf):
    """One crawl report per updated document, parsed with ``from_xml`` and exploded."""
    st = _status(spark, sf).where(F.col("update_type") != "same")
    reports = xml.parse_crawl_report_column(xml.document_report_xml(st))
    return xml.explode_crawl_report(reports).select("doc_id", "update_type", "id", "title", "uri")


@query("crawl_report_counts", with_ctes(SNAPSHOT_CTES + "," + _STATUS_SQL, """
SELECT update_type, count(*) AS n_reported, count(*) AS n_processed FROM status
WHERE update_type <> 'same' GROUP BY update_type"""))
def q_crawl_report_counts(spark, sf):
    """Crawl-report job (C1): reported vs processed rows per update type (Q11)."""
    prev, latest = _pair(spark, sf)
    st = _status(spark, sf).where(F.col("update_type") != "same")
    rows = xml.explode_crawl_report(xml.parse_crawl_report_column(xml.document_report_xml(st)))
    page = lambda df: df.select(
        F.concat(F.lit("https://manuals.example.org/"), F.col("manual"), F.lit("/"), F.lower("chapter")).alias("uri"),
        "text")
    return daily_jobs.crawl_report_job(rows, page(latest), page(prev), RUN_DATE)["counts"]


@query("newest_events", """
SELECT event_type, event_id, ts, CAST(rn AS INTEGER) AS rn FROM (
  SELECT event_type, event_id, ts, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) AS rn
  FROM events) WHERE rn <= 2""")
def q_newest_events(spark, sf):
    """The two newest rows per type (ties by id)."""
    ev = read_table(spark, sf, "events", ["event_type", "event_id", "ts"])
    return report.newest_rows(ev, "ts", 2, part="event_type", tie="event_id")


@query("newest_events_overall", """
SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id LIMIT 5""")
def q_newest_events_overall(spark, sf):
    """O2: top-k by time over the whole table (per-task top-k, then merge)."""
    ev = read_table(spark, sf, "events", ["event_id", "ts", "event_type"])
    return report.newest_rows(ev, "ts", 5, tie="event_id")


@query("archive_members", """
WITH m AS (SELECT doc_id, source || '/' || upper(lang) || '_ch_' || CAST(doc_id AS VARCHAR) || '.xml' AS member
           FROM documents),
g AS (SELECT DISTINCT d.source AS grp FROM labels l JOIN documents d ON l.doc_id = d.doc_id WHERE l.quality = 1)
SELECT doc_id, member,
       nullif(regexp_extract(member, '([^/]*)/([^./]*\\.xml)', 1), '') AS grp,
       nullif(regexp_extract(member, '([^/]*)/([^./]*\\.xml)', 2), '') AS filename,
       nullif(regexp_extract(member, '_([0-9]*)\\.xml', 1), '') AS doc_ref,
       nullif(regexp_extract(regexp_extract(member, '([^/]*)/([^./]*\\.xml)', 2), '^([^0-9_]+)_[^0-9]+_', 1), '') AS area
FROM m WHERE regexp_extract(member, '([^/]*)/([^./]*\\.xml)', 1) IN (SELECT grp FROM g)
  AND contains(member, 'xml')""")
def q_archive_members(spark, sf):
    """S6 + D5 + J13 + F6: member paths parsed, kept when their group is looked up."""
    docs = read_table(spark, sf, "documents", ["doc_id", "source", "lang", "text"])
    labels = read_table(spark, sf, "labels", ["doc_id", "quality"])
    groups = (labels.where("quality = 1").join(docs.select("doc_id", "source"), "doc_id")
              .select(F.col("source").alias("grp")))
    m = term_locations.member_paths(docs).select("doc_id", "member", *search.parse_member_path("member"))
    return search.members_in_groups(m.where(F.col("member").contains("xml")), groups).select(
        "doc_id", "member", "grp", "filename", "doc_ref", "area")


@query("page_bodies", r"""
SELECT page_id, url,
       regexp_extract(regexp_replace(html, '(?is)<nav\b.*?</nav>', '', 'g'),
                      '(?is)<article>(.*?)</article>', 1) AS body
FROM pages""")
def q_page_bodies(spark, sf):
    """S7 + D10 + M9: page table, navigation removed, body element extracted."""
    return daily_jobs.page_bodies(read_pages(spark, sf)).select(
        "page_id", "url", "body")


# =============================================================================
# Snapshot diff: J1-J4, F1, F1b, U1-U3
# =============================================================================
@query("deletions", with_ctes(SNAPSHOT_CTES, """
SELECT doc_id, chapter, manual, title FROM prev WHERE doc_id NOT IN (SELECT doc_id FROM latest)"""))
def q_deletions(spark, sf):
    """J1."""
    prev, latest = _pair(spark, sf)
    return snapshot.deletions(prev, latest).select("doc_id", "chapter", "manual", "title")


@query("additions", with_ctes(SNAPSHOT_CTES, """
SELECT doc_id, chapter, manual, title FROM latest WHERE doc_id NOT IN (SELECT doc_id FROM prev)"""))
def q_additions(spark, sf):
    """J2."""
    prev, latest = _pair(spark, sf)
    return snapshot.additions(prev, latest).select("doc_id", "chapter", "manual", "title")


@query("remainders", with_ctes(SNAPSHOT_CTES, """
SELECT doc_id, chapter FROM prev WHERE doc_id IN (SELECT doc_id FROM latest)"""))
def q_remainders(spark, sf):
    """Previous minus deletions (equal to latest minus additions)."""
    prev, latest = _pair(spark, sf)
    return snapshot.remainders(prev, latest)[0].select("doc_id", "chapter")


@query("remainder_mismatch", with_ctes(SNAPSHOT_CTES, """
SELECT doc_id FROM (
  (SELECT doc_id FROM prev WHERE doc_id IN (SELECT doc_id FROM latest)
   EXCEPT ALL SELECT doc_id FROM latest WHERE doc_id IN (SELECT doc_id FROM prev))
  UNION ALL
  (SELECT doc_id FROM latest WHERE doc_id IN (SELECT doc_id FROM prev)
   EXCEPT ALL SELECT doc_id FROM prev WHERE doc_id IN (SELECT doc_id FROM latest))) x"""))
def q_remainder_mismatch(spark, sf):
    """J3 invariant: the two remainders hold the same keys (result is empty)."""
    prev, latest = _pair(spark, sf)
    return snapshot.remainder_mismatch(prev, latest)


@query("document_merge", with_ctes(SNAPSHOT_CTES, """
SELECT coalesce(p.doc_id, l.doc_id) AS doc_id,
       CASE WHEN l.doc_id IS NULL THEN 'left_only' WHEN p.doc_id IS NULL THEN 'right_only' ELSE 'both' END AS _merge
FROM prev p FULL OUTER JOIN latest l ON p.doc_id = l.doc_id"""))
def q_document_merge(spark, sf):
    """Outer merge with indicator."""
    prev, latest = _pair(spark, sf)
    return snapshot.outer_merge(prev, latest)


@query("size_changed", with_ctes(SNAPSHOT_CTES, """
SELECT p.doc_id, CAST(octet_length(encode(p.text)) AS INTEGER) AS prev_size,
       CAST(octet_length(encode(l.text)) AS INTEGER) AS curr_size
FROM prev p JOIN latest l ON p.doc_id = l.doc_id
WHERE octet_length(encode(p.text)) <> octet_length(encode(l.text))"""))
def q_size_changed(spark, sf):
    """common documents whose byte size differs."""
    prev, latest = _pair(spark, sf)
    return snapshot.size_changed(prev, latest)


@query("content_changed", with_ctes(SNAPSHOT_CTES, """
SELECT p.doc_id, CAST(octet_length(encode(p.text)) AS INTEGER) AS prev_size,
       CAST(octet_length(encode(l.text)) AS INTEGER) AS curr_size
FROM prev p JOIN latest l ON p.doc_id = l.doc_id WHERE p.text <> l.text"""))
def q_content_changed(spark, sf):
    """Common documents whose content differs (same-size edits included)."""
    prev, latest = _pair(spark, sf)
    return snapshot.content_changed(prev, latest)


@query("keys_except", with_ctes(SNAPSHOT_CTES, """
SELECT doc_id FROM prev EXCEPT ALL SELECT doc_id FROM latest"""))
def q_keys_except(spark, sf):
    """Key list difference (agrees with J1)."""
    prev, latest = _pair(spark, sf)
    return snapshot.keys_except(prev, latest)


@query("keys_intersect", with_ctes(SNAPSHOT_CTES, """
SELECT doc_id FROM prev INTERSECT SELECT doc_id FROM latest"""))
def q_keys_intersect(spark, sf):
    """Keys in both snapshots."""
    prev, latest = _pair(spark, sf)
    return snapshot.keys_intersect(prev, latest)


# =============================================================================
# Projections: P1-P7
# =============================================================================
@query("page_fields", r"""
SELECT page_id,
       coalesce(nullif(regexp_extract(html, '(?is)<title>(.*?)</title>', 1), ''), 'not found') AS title,
       coalesce(nullif(regexp_extract(html, '(?is)<h1\b[^>]*>(.*?)</h1>', 1), ''), 'not found') AS heading,
       'View changes' AS link
FROM pages""")
def q_page_fields(spark, sf):
    """P1 + P5: fields with a ``not found`` default, and a literal column."""
    pages = read_pages(spark, sf)
    title = F.coalesce(X.extract_or_null("html", r"(?is)<title>(.*?)</title>"), F.lit("not found"))
    heading = F.coalesce(X.extract_or_null("html", r"(?is)<h1\b[^>]*>(.*?)</h1>"), F.lit("not found"))
    return pages.select("page_id", title.alias("title"), heading.alias("heading"), F.lit("View changes").alias("link"))


_METRICS_SQL = f"""
changed AS (SELECT p.doc_id, p.manual, p.chapter, p.title, p.text AS pt, l.text AS lt
            FROM prev p JOIN latest l ON p.doc_id = l.doc_id WHERE p.text <> l.text),
cpp AS (SELECT s.doc_id, CAST(u.pos AS INTEGER) AS pos, regexp_replace(u.t, '\\s$', '') AS t
        FROM changed s, unnest(string_split(s.pt, chr(10))) WITH ORDINALITY AS u(t, pos)),
clp AS (SELECT s.doc_id, CAST(u.pos AS INTEGER) AS pos, regexp_replace(u.t, '\\s$', '') AS t
        FROM changed s, unnest(string_split(s.lt, chr(10))) WITH ORDINALITY AS u(t, pos)),
cpairs AS (SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, coalesce(a.t, '') AS p, coalesce(b.t, '') AS c
           FROM cpp a FULL OUTER JOIN clp b ON a.doc_id = b.doc_id AND a.pos = b.pos),
pagg AS (SELECT doc_id, CAST(sum({lev('p', 'c')}) AS BIGINT) AS tlt,
                CAST(sum(CASE WHEN p <> c THEN 1 ELSE 0 END) AS BIGINT) AS pcc, CAST(count(*) AS BIGINT) AS pc
         FROM cpairs GROUP BY doc_id),
metrics AS (SELECT c.doc_id, c.manual AS source, c.chapter AS chapter_number, c.title,
                   CAST({lev('c.pt', 'c.lt')} AS BIGINT) AS lev_distance,
                   CAST(abs(length(c.pt) - length(c.lt)) AS BIGINT) AS char_count_diff,
                   a.tlt AS text_lev_total, a.pcc AS para_change_count, a.pc AS para_count
            FROM changed c JOIN pagg a ON c.doc_id = a.doc_id)"""


@query("change_table", with_ctes(SNAPSHOT_CTES + "," + _METRICS_SQL, f"""
SELECT doc_id, source, chapter_number, title, CAST(lev_distance AS INTEGER) AS lev_distance,
       concat('Lev Distance: ', lev_distance, '<br />CharCountDiff: ', char_count_diff,
              '<br />Changed paras: ', para_change_count, ' out of ', para_count) AS change_info,
       replace(replace('<a href="chapters/' || chapter_number || '.html" target="_blank">View</a>', '—', ' '), '’', '''') AS html,
       '<a href="chapters/' || chapter_number || '-comp.docx" target="_blank">Download</a>' AS tracked_changes
FROM metrics WHERE para_change_count <> 0 AND lev_distance > {SIGNIFICANCE_THRESHOLD}"""))
def q_change_table(spark, sf):
    """P2 + P3 + P4 + F2: the published change list."""
    prev, latest = _pair(spark, sf)
    return document_changes.change_table(scoring.document_metrics(prev, latest))


@query("version_stamps", """
SELECT event_id, event_type || '-' || strftime(ts, '%Y%m%d') AS version_key,
       strftime(ts, '%d-%m-%Y') AS report_date,
       concat_ws('/', 'archive', event_type, event_type || '-' || strftime(ts, '%Y%m%d')) AS archive_path
FROM events""")
def q_version_stamps(spark, sf):
    """P6 + D14: version keys, report dates and archive paths."""
    ev = read_table(spark, sf, "events", ["event_id", "event_type", "ts"])
    key = F.concat_ws("-", "event_type", F.date_format("ts", "yyyyMMdd"))
    return ev.select("event_id", key.alias("version_key"), F.date_format("ts", "dd-MM-yyyy").alias("report_date"),
                     F.concat_ws("/", F.lit("archive"), "event_type", key).alias("archive_path"))


@query("addition_info", with_ctes(SNAPSHOT_CTES, """
SELECT doc_id, manual AS source, chapter AS chapter_number, title,
       '<a href="chapters/' || chapter || '.html" target="_blank">View</a>' AS link
FROM latest WHERE doc_id NOT IN (SELECT doc_id FROM prev)"""))
def q_addition_info(spark, sf):
    """Document info for the additions list."""
    prev, latest = _pair(spark, sf)
    return document_changes.document_info(snapshot.additions(prev, latest))


@query("deletion_info", with_ctes(SNAPSHOT_CTES, """
SELECT doc_id, manual AS source, chapter AS chapter_number, title,
       '<a href="chapters/' || chapter || '.html" target="_blank">View</a>' AS link
FROM prev WHERE doc_id NOT IN (SELECT doc_id FROM latest)"""))
def q_deletion_info(spark, sf):
    """Document info for the deletions list."""
    prev, latest = _pair(spark, sf)
    return document_changes.document_info(snapshot.deletions(prev, latest))


# =============================================================================
# Filters: F2-F15
# =============================================================================
@query("document_metrics", with_ctes(SNAPSHOT_CTES + "," + _METRICS_SQL, "SELECT * FROM metrics"))
def q_document_metrics(spark, sf):
    """A3 (+ D1, D2, D3): per-document change metrics of every changed document."""
    prev, latest = _pair(spark, sf)
    return scoring.document_metrics(prev, latest)


@query("significant_changes", with_ctes(SNAPSHOT_CTES + "," + _METRICS_SQL, f"""
SELECT * FROM metrics WHERE para_change_count <> 0 AND lev_distance > {SIGNIFICANCE_THRESHOLD}"""))
def q_significant_changes(spark, sf):
    """F2."""
    prev, latest = _pair(spark, sf)
    return scoring.significant_changes(scoring.document_metrics(prev, latest))


@query("threshold_flags", with_ctes(SNAPSHOT_CTES, f"""
SELECT coalesce(p.doc_id, l.doc_id) AS doc_id,
       CASE WHEN p.doc_id IS NULL THEN 'new' WHEN l.doc_id IS NULL THEN 'deletion'
            WHEN p.text <> l.text THEN 'change' ELSE 'same' END AS update_type,
       CASE WHEN p.doc_id IS NULL OR l.doc_id IS NULL THEN true
            ELSE {lev('p.text', 'l.text')} > {SIGNIFICANCE_THRESHOLD} END AS above_threshold
FROM prev p FULL OUTER JOIN latest l ON p.doc_id = l.doc_id"""))
def q_threshold_flags(spark, sf):
    """bounded-distance flag (TRUE for new / deleted documents)."""
    prev, latest = _pair(spark, sf)
    return scoring.threshold_flags(prev, latest)


@query("paragraph_log", with_ctes(LOG_CTES, "SELECT doc_id, chapter, k, pos, para, key FROM llog"))
def q_paragraph_log(spark, sf):
    """F4 + W3: noise paragraphs dropped, kept ones numbered, ``chapter_k`` keys."""
    latest = _pair(spark, sf)[1]
    return paragraphs.numbered_paragraphs(latest).select("doc_id", "chapter", "k", "pos", "para", "key")


@query("page_elements", r"""
SELECT page_id, CAST(u.pos - 1 AS INTEGER) AS pos, u.t AS inner_text
FROM pages, unnest(regexp_extract_all(html, '(?is)<p\b[^>]*>(.*?)</p>', 1)) WITH ORDINALITY AS u(t, pos)
WHERE u.t IS NOT NULL AND u.t <> ' ' AND u.t <> ''""")
def q_page_elements(spark, sf):
    """D13 + F5: ``<p>`` elements of every page in order, blank ones dropped."""
    pages = read_pages(spark, sf)
    return (pages.select("page_id", F.posexplode(H.element_texts("html", "p")).alias("pos", "inner_text"))
            .where(F.col("inner_text").isNotNull() & (F.col("inner_text") != " ") & (F.col("inner_text") != "")))


@query("events_today", f"""
SELECT event_id, ts, event_type FROM events WHERE CAST(ts AS DATE) = DATE '{RUN_DATE}'""")
def q_events_today(spark, sf):
    """rows of the run date."""
    ev = read_table(spark, sf, "events", ["event_id", "ts", "event_type"])
    return feed.today_only(ev, RUN_DATE)


@query("events_take_while", f"""
SELECT event_id, ts, event_type FROM events
WHERE CAST(ts AS DATE) = DATE '{RUN_DATE}'
  AND ts > coalesce((SELECT max(ts) FROM events WHERE CAST(ts AS DATE) <> DATE '{RUN_DATE}'), TIMESTAMP '0001-01-01')""")
def q_events_take_while(spark, sf):
    """F7 ordered: newest-first feed read until the first row of another date."""
    ev = read_table(spark, sf, "events", ["event_id", "ts", "event_type"])
    return feed.take_while_today(ev, RUN_DATE)


@query("events_take_while_newest", """
SELECT event_id, ts, event_type FROM events
WHERE CAST(ts AS DATE) = (SELECT CAST(max(ts) AS DATE) FROM events)
  AND ts > coalesce((SELECT max(ts) FROM events WHERE CAST(ts AS DATE) <> (SELECT CAST(max(ts) AS DATE) FROM events)),
                    TIMESTAMP '0001-01-01')""")
def q_events_take_while_newest(spark, sf):
    """F7 ordered, run on the day of the newest row."""
    ev = read_table(spark, sf, "events", ["event_id", "ts", "event_type"])
    return feed.take_while_today(ev, ev.agg(F.to_date(F.max("ts"))).scalar())


@query("page_links", r"""
SELECT page_id, url,
       nullif(regexp_extract(url, '^[A-Za-z]+://[^/]+/([^/?#]*)', 1), '') AS manual,
       nullif(regexp_extract(url, '^[A-Za-z]+://[^/]+/([^/?#]*)/([^/?#]*)', 2), '') AS chapter
FROM pages
WHERE contains(url, '.example.')
  AND nullif(regexp_extract(url, '^[A-Za-z]+://[^/]+/([^/?#]*)', 1), '') IS NOT NULL
  AND nullif(regexp_extract(url, '^[A-Za-z]+://[^/]+/([^/?#]*)/([^/?#]*)', 2), '') IS NOT NULL""")
def q_page_links(spark, sf):
    """F8 + D5: links of the wanted kind with manual and chapter parsed."""
    pages = read_pages(spark, sf).select("page_id", "url")
    return feed.link_parts(pages, "url", marker=".example.")


@query("withheld_pages", """
SELECT page_id, contains(html, 'content has been withheld because of exemptions in the Freedom of Information Act')
                OR contains(html, 'Page Archived') AS withheld
FROM pages""")
def q_withheld_pages(spark, sf):
    """withheld-phrase flag per page."""
    from palimpsest.constants import WITHHELD_PHRASES
    return read_pages(spark, sf).select("page_id", X.contains_any("html", WITHHELD_PHRASES).alias("withheld"))


@query("feed_date_gate", f"""
SELECT CAST(max(ts) AS DATE) AS newest_date, DATE '{RUN_DATE}' AS run_date,
       CASE WHEN CAST(max(ts) AS DATE) = DATE '{RUN_DATE}' THEN 'ok' ELSE 'stale' END AS status
FROM events""")
def q_feed_date_gate(spark, sf):
    """run only when the newest feed date is the run date."""
    ev = read_table(spark, sf, "events", ["ts"])
    return feed.date_gate(ev, RUN_DATE)


PAIRED_LOG_SQL = """
paired AS (SELECT p.doc_id, p.k, p.key, p.chapter, p.chapter AS prev_chapter, l.chapter AS curr_chapter,
                  p.title AS prev_title, l.title AS curr_title,
                  regexp_replace(p.para, ' $', '') AS prev_para, regexp_replace(l.para, ' $', '') AS curr_para
           FROM plog p JOIN llog l ON p.doc_id = l.doc_id AND p.k = l.k),
changed_p AS (SELECT * FROM paired WHERE
   (coalesce(prev_chapter, 'nan') <> '' AND curr_chapter IS NOT NULL AND coalesce(prev_chapter, 'nan') <> curr_chapter)
OR (coalesce(prev_title, 'nan') <> '' AND curr_title IS NOT NULL AND coalesce(prev_title, 'nan') <> curr_title)
OR (coalesce(prev_para, 'nan') <> '' AND curr_para IS NOT NULL AND coalesce(prev_para, 'nan') <> curr_para)),
flagged AS (SELECT c.*, EXISTS (SELECT 1 FROM llog l2 WHERE l2.doc_id = c.doc_id
                                 AND regexp_replace(l2.para, ' $', '') = c.prev_para AND l2.k <> c.k) AS shifted
            FROM changed_p c)"""


@query("changed_paragraphs", with_ctes(LOG_CTES + "," + PAIRED_LOG_SQL, """
SELECT doc_id, k, key, prev_title, curr_title, prev_para, curr_para, shifted FROM flagged"""))
def q_changed_paragraphs(spark, sf):
    """J4b + D3 + J5 + F11 + J8: changed paragraph pairs with the shift flag."""
    prev, latest = _pair(spark, sf)
    plog, llog = paragraph_changes.logs(prev, latest, together=True)
    fl = paragraph_changes.with_shift(paragraph_changes.changed(paragraph_changes.paired(plog, llog)), llog)
    return fl.select("doc_id", "k", "key", "prev_title", "curr_title", "prev_para", "curr_para", "shifted")


@query("unshifted_changes", with_ctes(LOG_CTES + "," + PAIRED_LOG_SQL, """
SELECT doc_id, k, key, prev_para, curr_para,
       CAST(count(*) OVER (PARTITION BY chapter) AS BIGINT) AS n_paras_with_changes
FROM flagged WHERE NOT shifted"""))
def q_unshifted_changes(spark, sf):
    """F13 + W1: unshifted changes with their per-chapter count (taken before F12)."""
    from pyspark.sql.window import Window
    prev, latest = _pair(spark, sf)
    plog, llog = paragraph_changes.logs(prev, latest, together=True)
    fl = paragraph_changes.with_shift(paragraph_changes.changed(paragraph_changes.paired(plog, llog)), llog)
    return (fl.where(~F.col("shifted"))
            .withColumn("n_paras_with_changes", F.count(F.lit(1)).over(Window.partitionBy("chapter")))
            .select("doc_id", "k", "key", "prev_para", "curr_para", "n_paras_with_changes"))


CASCADE_SQL = f"""
counted AS (SELECT *, CAST(count(*) OVER (PARTITION BY chapter) AS BIGINT) AS n_paras_with_changes
            FROM flagged WHERE NOT shifted),
scored AS (SELECT *, CAST(abs(length(prev_para) - length(curr_para)) AS BIGINT) AS char_count_diff,
                  CAST({lev('prev_para', 'curr_para')} AS BIGINT) AS lev_distance FROM counted),
levchar AS (SELECT * FROM scored
            WHERE CASE WHEN char_count_diff < 10 THEN lev_distance > char_count_diff + 10 ELSE true END),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY chapter ORDER BY k) AS rn FROM levchar) x
           WHERE rn = 1)"""


@query("chapter_changes", with_ctes(LOG_CTES + "," + PAIRED_LOG_SQL + "," + CASCADE_SQL, """
SELECT doc_id, chapter, prev_title AS title, k, prev_para, curr_para, n_paras_with_changes,
       char_count_diff, lev_distance FROM firsts"""))
def q_chapter_changes(spark, sf):
    """F12 + W2 (+ D1, D2): the paragraph comparison's one row per chapter."""
    prev, latest = _pair(spark, sf)
    return paragraph_changes.chapter_summary(prev, latest)


@query("levchar_flags", with_ctes(LOG_CTES + "," + PAIRED_LOG_SQL + "," + CASCADE_SQL, """
SELECT doc_id, k, char_count_diff, lev_distance,
       CASE WHEN char_count_diff < 10 THEN lev_distance > char_count_diff + 10 ELSE true END AS levchar
FROM scored"""))
def q_levchar_flags(spark, sf):
    """F12 flag on every unshifted changed paragraph."""
    prev, latest = _pair(spark, sf)
    plog, llog = paragraph_changes.logs(prev, latest, together=True)
    fl = paragraph_changes.with_shift(paragraph_changes.changed(paragraph_changes.paired(plog, llog)), llog)
    return (fl.where(~F.col("shifted"))
            .select("doc_id", "k", X.length_diff("prev_para", "curr_para").cast("long").alias("char_count_diff"),
                    long_edit_distance("prev_para", "curr_para").alias("lev_distance"))
            .withColumn("levchar", X.levchar_flag("lev_distance", "char_count_diff")))


_CLASSIFIED_SQL = r"""
links AS (SELECT page_id, url,
                 regexp_extract(regexp_replace(html, '(?is)<nav\b.*?</nav>', '', 'g'), '(?is)<article>(.*?)</article>', 1) AS body,
                 nullif(regexp_extract(url, '^[A-Za-z]+://[^/]+/([^/?#]*)', 1), '') AS manual,
                 nullif(regexp_extract(url, '^[A-Za-z]+://[^/]+/([^/?#]*)/([^/?#]*)', 2), '') AS chapter
          FROM pages),
classified AS (SELECT page_id, manual, chapter,
                      CASE WHEN TRY_CAST(chapter AS BIGINT) IN (SELECT doc_id FROM prev) THEN 'change'
                           WHEN contains(body, 'content has been withheld because of exemptions in the Freedom of Information Act')
                                OR contains(body, 'Page Archived') THEN 'deletion'
                           ELSE 'new' END AS update_type
               FROM links WHERE manual IS NOT NULL AND chapter IS NOT NULL)"""


@query("page_update_types", with_ctes(SNAPSHOT_CTES + "," + _CLASSIFIED_SQL,
                                      "SELECT page_id, manual, chapter, update_type FROM classified"))
def q_page_update_types(spark, sf):
    """J12 + F9 + F8: change / deletion / new against yesterday's archive."""
    prev = _pair(spark, sf)[0]
    return daily_jobs.classified_pages(read_pages(spark, sf), prev).select(
        "page_id", "manual", "chapter", "update_type")


@query("page_changes", with_ctes(SNAPSHOT_CTES + "," + _CLASSIFIED_SQL,
                                 "SELECT page_id, manual, chapter FROM classified WHERE update_type = 'change'"))
def q_page_changes(spark, sf):
    """rows of one update type."""
    prev = _pair(spark, sf)[0]
    c = daily_jobs.classified_pages(read_pages(spark, sf), prev)
    return feed.of_type(c, "change").select("page_id", "manual", "chapter")


@query("update_table", with_ctes(SNAPSHOT_CTES + "," + _CLASSIFIED_SQL, f"""
SELECT page_id,
       array_to_string(list_transform(string_split(lower(replace(manual, '-', ' ')), ' '),
                                      lambda w: replace(upper(left(w, 1)), 'ẞ', 'Ss') || substr(w, 2)), ' ') AS manual,
       upper(chapter) AS chapter, update_type,
       chapter || '-' || strftime(DATE '{RUN_DATE}', '%Y%m%d') AS version_key,
       strftime(DATE '{RUN_DATE}', '%d-%m-%Y') AS report_date
FROM classified"""))
def q_update_table(spark, sf):
    """D7 + P6 + D14: the published update rows."""
    prev = _pair(spark, sf)[0]
    return daily_jobs.update_table(daily_jobs.classified_pages(read_pages(spark, sf), prev), RUN_DATE)


@query("report_parse_status", None)
def q_report_parse_status(spark, sf):
    """page markup read as crawl reports; ill-formed rows are a side output.

    Rows-only check: which page parses as a report depends on XML parser
    recovery rules that SQL cannot reproduce.
    """
    pages = read_pages(spark, sf).select("page_id", F.col("html").alias("report_xml"))
    parsed = xml.parse_crawl_report_column(pages)
    return parsed.select("page_id", F.col("_corrupt_record").isNotNull().alias("ill_formed"))


# =============================================================================
# Paragraph joins: J4 (logs), J4b, J5, J6, J8, J15
# =============================================================================
@query("paragraph_merge", with_ctes(LOG_CTES, """
SELECT coalesce(p.key, l.key) AS key, p.para AS prev_para, l.para AS curr_para,
       CASE WHEN p.para IS NULL THEN 'right_only' WHEN l.para IS NULL THEN 'left_only' ELSE 'both' END AS _merge
FROM plog p FULL OUTER JOIN llog l ON p.key = l.key"""))
def q_paragraph_merge(spark, sf):
    """J4 on the paragraph logs."""
    prev, latest = _pair(spark, sf)
    plog, llog = paragraph_changes.logs(prev, latest)
    return paragraphs.outer_merge_paragraphs(plog, llog)


@query("new_paragraphs", with_ctes(LOG_CTES, """
SELECT key, doc_id, k, para FROM llog WHERE key NOT IN (SELECT key FROM plog)"""))
def q_new_paragraphs(spark, sf):
    """J4 right_only / J4b: paragraph keys only in the latest log."""
    prev, latest = _pair(spark, sf)
    plog, llog = paragraph_changes.logs(prev, latest)
    return paragraph_changes.new_paragraphs(plog, llog).select("key", "doc_id", "k", "para")


@query("deleted_paragraph_keys", with_ctes(LOG_CTES, """
SELECT key, doc_id, k, para FROM plog WHERE key NOT IN (SELECT key FROM llog)"""))
def q_deleted_paragraph_keys(spark, sf):
    """J4 left_only / J4b: paragraph keys only in the previous log."""
    prev, latest = _pair(spark, sf)
    plog, llog = paragraph_changes.logs(prev, latest)
    return paragraph_changes.deleted_paragraphs(plog, llog).select("key", "doc_id", "k", "para")


@query("paragraph_pairs", with_ctes(PARAGRAPH_CTES, "SELECT doc_id, pos, prev_text, curr_text, status FROM pairs"))
def q_paragraph_pairs(spark, sf):
    """J6 (+ D3, D13): full outer positional pairing with status."""
    pp, lp = _paras(spark, sf)
    return paragraphs.pair_paragraphs(pp, lp)


@query("inner_paragraph_pairs", with_ctes(PARAGRAPH_CTES, """
SELECT doc_id, pos, prev_text, curr_text, status FROM pairs WHERE prev_text IS NOT NULL AND curr_text IS NOT NULL"""))
def q_inner_paragraph_pairs(spark, sf):
    """Inner positional pairing."""
    pp, lp = _paras(spark, sf)
    return paragraphs.pair_paragraphs(pp, lp, "inner")


@query("shifted_paragraphs", with_ctes(PARAGRAPH_CTES, """
SELECT p.doc_id, p.pos, p.prev_text,
       EXISTS (SELECT 1 FROM lp WHERE lp.doc_id = p.doc_id AND lp.text = p.prev_text AND lp.pos <> p.pos) AS shifted
FROM pairs p WHERE p.status = 'changed'"""))
def q_shifted_paragraphs(spark, sf):
    """Is a changed paragraph's old text found elsewhere in the new document?"""
    pp, lp = _paras(spark, sf)
    ch = paragraphs.pair_paragraphs(pp, lp, "inner").where(F.col("status") == "changed")
    return paragraphs.mark_found_elsewhere(ch, lp).select("doc_id", "pos", "prev_text", "shifted")


@query("inserted_paragraphs", with_ctes(PARAGRAPH_CTES, """
SELECT doc_id, pos, text FROM lp
WHERE text IS NOT NULL AND NOT EXISTS (SELECT 1 FROM pp WHERE pp.doc_id = lp.doc_id AND pp.text = lp.text)"""))
def q_inserted_paragraphs(spark, sf):
    """New paragraphs found nowhere in the old document."""
    pp, lp = _paras(spark, sf)
    return paragraphs.found_nowhere(lp, pp).select("doc_id", "pos", "text")


@query("deleted_paragraphs", with_ctes(PARAGRAPH_CTES, """
SELECT doc_id, pos, text FROM pp
WHERE text IS NOT NULL AND NOT EXISTS (SELECT 1 FROM lp WHERE lp.doc_id = pp.doc_id AND lp.text = pp.text)"""))
def q_deleted_paragraphs(spark, sf):
    """Old paragraphs found nowhere in the new document."""
    pp, lp = _paras(spark, sf)
    return paragraphs.found_nowhere(pp, lp).select("doc_id", "pos", "text")


# =============================================================================
# Relevance: A1, A2, A4, J7, J9, J10, J11
# =============================================================================
REFS_SQL = """
refs AS (SELECT concat(upper(d.lang), CAST(d.doc_id AS VARCHAR)) AS pattern,
                'L' || CAST(l.doc_id AS VARCHAR) AS doc_ref
         FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def _refs(spark, sf):
    """Reference locations: each labelled document refers to its own chapter."""
    labels = read_table(spark, sf, "labels", ["doc_id"])
    docs = read_table(spark, sf, "documents", ["doc_id", "lang"])
    return labels.join(docs, "doc_id").select(
        F.concat(F.upper("lang"), F.col("doc_id").cast("string")).alias("pattern"),
        F.concat(F.lit("L"), F.col("doc_id").cast("string")).alias("doc_ref"))


@query("distinct_patterns", with_ctes(REFS_SQL, "SELECT DISTINCT pattern FROM refs"))
def q_distinct_patterns(spark, sf):
    """A1: distinct patterns."""
    return relevance.distinct_values(_refs(spark, sf), "pattern")


@query("source_prefixes", with_ctes(REFS_SQL, "SELECT DISTINCT regexp_extract(pattern, '^[^0-9]+', 0) AS source FROM refs"))
def q_source_prefixes(spark, sf):
    """A1 + D5: distinct source prefixes."""
    return relevance.distinct_prefixes(_refs(spark, sf), "pattern")


@query("refs_per_pattern", with_ctes(REFS_SQL, """
SELECT pattern, doc_ref, count(*) OVER (PARTITION BY pattern) AS n_refs FROM refs"""))
def q_refs_per_pattern(spark, sf):
    """A2: referring documents per pattern in long form, with the pattern's count."""
    return relevance.refs_with_counts(_refs(spark, sf))


@query("rows_per_pattern", with_ctes(REFS_SQL, """
SELECT pattern, count(*) AS n_refs FROM refs GROUP BY pattern"""))
def q_rows_per_pattern(spark, sf):
    """A4."""
    return relevance.rows_per_pattern(_refs(spark, sf))


@query("chapter_changes_with_refs", with_ctes(
    LOG_CTES + "," + PAIRED_LOG_SQL + "," + CASCADE_SQL + "," + REFS_SQL, """
SELECT f.doc_id, f.chapter, f.n_paras_with_changes, coalesce(r.doc_info, '') AS doc_info
FROM firsts f LEFT JOIN (SELECT pattern, array_to_string(list_sort(list(doc_ref)), ', ') AS doc_info
                         FROM refs GROUP BY pattern) r ON f.chapter = r.pattern"""))
def q_chapter_changes_with_refs(spark, sf):
    """J7 + D15: referring documents attached to each changed chapter."""
    prev, latest = _pair(spark, sf)
    out = paragraph_changes.chapter_summary(prev, latest, _refs(spark, sf))
    return out.select("doc_id", "chapter", "n_paras_with_changes", "doc_info")


@query("relevance_flags", with_ctes(SNAPSHOT_CTES + "," + REFS_SQL, """
SELECT doc_id, chapter, chapter IN (SELECT pattern FROM refs) AS relevant FROM latest"""))
def q_relevance_flags(spark, sf):
    """Is the chapter in the pattern list?"""
    latest = _pair(spark, sf)[1]
    return relevance.relevance_flag(latest.select("doc_id", "chapter"), _refs(spark, sf))


@query("source_relevant_changes", with_ctes(SNAPSHOT_CTES + "," + REFS_SQL, """
SELECT p.doc_id, p.chapter FROM prev p JOIN latest l ON p.doc_id = l.doc_id
WHERE p.text <> l.text AND regexp_extract(p.chapter, '^[^0-9]+', 0) IN (
  SELECT DISTINCT regexp_extract(r.pattern, '^[^0-9]+', 0) FROM refs r JOIN labels lb
    ON r.doc_ref = 'L' || CAST(lb.doc_id AS VARCHAR) WHERE lb.toxic = 1)"""))
def q_source_relevant_changes(spark, sf):
    """Changed chapters whose prefix is in the prefix list (prefixes of flagged documents)."""
    prev, latest = _pair(spark, sf)
    labels = read_table(spark, sf, "labels", ["doc_id", "toxic"])
    flagged = _refs(spark, sf).join(
        labels.where("toxic = 1").select(F.concat(F.lit("L"), F.col("doc_id").cast("string")).alias("doc_ref")),
        "doc_ref", "left_semi")
    prefixes = relevance.distinct_prefixes(flagged, "pattern")
    changed = snapshot.content_changed(prev, latest, keep=("chapter",))
    return relevance.source_relevant(changed.select("doc_id", "chapter"), prefixes)


@query("team_changes", with_ctes(SNAPSHOT_CTES + "," + _METRICS_SQL + "," + _TEAM_VALUES, f"""
SELECT t.team, m.doc_id, m.source, m.lev_distance FROM metrics m JOIN teams t ON m.source = t.source
WHERE m.para_change_count <> 0 AND m.lev_distance > {SIGNIFICANCE_THRESHOLD}"""))
def q_team_changes(spark, sf):
    """Significant changes per team, all teams in one pass."""
    prev, latest = _pair(spark, sf)
    sig = scoring.significant_changes(scoring.document_metrics(prev, latest))
    return relevance.team_rows(sig, csv_lists.read_team_lists(spark)).select("team", "doc_id", "source",
                                                                               "lev_distance")


@query("team_additions", with_ctes(SNAPSHOT_CTES + "," + _TEAM_VALUES, """
SELECT doc_id, manual, chapter FROM latest
WHERE doc_id NOT IN (SELECT doc_id FROM prev) AND manual IN (SELECT source FROM teams WHERE team = 'beta')"""))
def q_team_additions(spark, sf):
    """J11 single team: ``Source isin`` one team list, as a semi-join."""
    prev, latest = _pair(spark, sf)
    teams = csv_lists.read_team_lists(spark).where(F.col("team") == "beta")
    return relevance.team_filter(snapshot.additions(prev, latest), teams, "manual").select(
        "doc_id", "manual", "chapter")


# =============================================================================
# Reports, counts, sorts, unions: K2, K3, K4, A5, A7, O1, U3
# =============================================================================
_SECTIONS_SQL = f"""
sections AS (
  SELECT 'changes' AS section, source, chapter_number, title,
         concat('Lev Distance: ', lev_distance, '<br />CharCountDiff: ', char_count_diff,
                '<br />Changed paras: ', para_change_count, ' out of ', para_count) AS info
  , lev_distance AS sort_key
  FROM metrics WHERE para_change_count <> 0 AND lev_distance > {SIGNIFICANCE_THRESHOLD}
  UNION ALL
  SELECT 'additions', manual, chapter, title, CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT)
  FROM latest WHERE doc_id NOT IN (SELECT doc_id FROM prev)
  UNION ALL
  SELECT 'deletions', manual, chapter, title, CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT)
  FROM prev WHERE doc_id NOT IN (SELECT doc_id FROM latest))"""


def _sections(spark, sf):
    prev, latest = _pair(spark, sf)
    return document_changes.build(prev, latest)["report"]


@query("report_sections", with_ctes(SNAPSHOT_CTES + "," + _METRICS_SQL + "," + _SECTIONS_SQL,
                                    "SELECT * FROM sections"))
def q_report_sections(spark, sf):
    """K2 + U3: changes, additions and deletions in one report table (with its sort key)."""
    return _sections(spark, sf)


@query("section_counts", with_ctes(SNAPSHOT_CTES + "," + _METRICS_SQL + "," + _SECTIONS_SQL, """
SELECT coalesce(section, 'ALL') AS section, count(*) AS n FROM sections GROUP BY ROLLUP (section)"""))
def q_section_counts(spark, sf):
    """A5: rows per section plus the ALL total."""
    return report.section_counts(_sections(spark, sf))


@query("team_section_counts", with_ctes(
    SNAPSHOT_CTES + "," + _METRICS_SQL + "," + _SECTIONS_SQL + "," + _TEAM_VALUES, """
SELECT team, coalesce(section, 'ALL') AS section, count(*) AS n
FROM sections s JOIN teams t ON s.source = t.source GROUP BY ROLLUP (team, section) HAVING team IS NOT NULL"""))
def q_team_section_counts(spark, sf):
    """A5 per team (J11 then rollup)."""
    sections = _sections(spark, sf)
    by_team = relevance.team_rows(sections, csv_lists.read_team_lists(spark))
    return report.section_counts(sections, by_team)


@query("team_section_matrix", with_ctes(
    SNAPSHOT_CTES + "," + _METRICS_SQL + "," + _SECTIONS_SQL + "," + _TEAM_VALUES, """
SELECT coalesce(team, 'ALL') AS team, count(*) FILTER (WHERE section = 'changes') AS changes,
       count(*) FILTER (WHERE section = 'additions') AS additions, count(*) FILTER (WHERE section = 'deletions') AS deletions, count(*) AS total
FROM sections s JOIN teams t ON s.source = t.source GROUP BY ROLLUP (team)"""))
def q_team_section_matrix(spark, sf):
    """A5 wide: team x section counts with an ALL row and a total column."""
    return report.section_matrix(relevance.team_rows(_sections(spark, sf), csv_lists.read_team_lists(spark)))


@query("sorted_changes", with_ctes(SNAPSHOT_CTES + "," + _METRICS_SQL, """
SELECT doc_id, chapter_number, lev_distance FROM metrics ORDER BY lev_distance DESC, chapter_number"""))
def q_sorted_changes(spark, sf):
    """O1: change list by distance, largest first."""
    prev, latest = _pair(spark, sf)
    return report.sorted_changes(scoring.document_metrics(prev, latest).select("doc_id", "chapter_number", "lev_distance"))


@query("ranked_changes", with_ctes(SNAPSHOT_CTES + "," + _METRICS_SQL, """
SELECT row_number() OVER (ORDER BY lev_distance DESC, chapter_number, doc_id) AS rank, doc_id, chapter_number, lev_distance
FROM metrics"""))
def q_ranked_changes(spark, sf):
    """O1: every changed document with its rank by distance."""
    prev, latest = _pair(spark, sf)
    return report.ranked_changes(scoring.document_metrics(prev, latest).select("doc_id", "chapter_number", "lev_distance")).select(
        "rank", "doc_id", "chapter_number", "lev_distance")


@query("ranked_report", with_ctes(SNAPSHOT_CTES + "," + _METRICS_SQL + "," + _SECTIONS_SQL, """
SELECT row_number() OVER (ORDER BY section, sort_key DESC NULLS LAST, chapter_number DESC, source) AS rank,
       row_number() OVER (PARTITION BY section ORDER BY sort_key DESC NULLS LAST, chapter_number DESC, source) AS section_rank,
       section, source, chapter_number, title, info
FROM sections"""))
def q_ranked_report(spark, sf):
    """K2 + O1: the report's rows with their rank over all sections and within each."""
    return report.ranked_report(_sections(spark, sf)).select(
        "rank", "section_rank", "section", "source", "chapter_number", "title", "info")


@query("changes_union", with_ctes(SNAPSHOT_CTES, """
SELECT doc_id, chapter, 'deletion' AS update_type FROM prev WHERE doc_id NOT IN (SELECT doc_id FROM latest)
UNION ALL
SELECT doc_id, chapter, 'new' AS update_type FROM latest WHERE doc_id NOT IN (SELECT doc_id FROM prev)"""))
def q_changes_union(spark, sf):
    """U3 + P5: deletions and additions appended, with a literal type column."""
    prev, latest = _pair(spark, sf)
    d = snapshot.deletions(prev, latest).select("doc_id", "chapter", F.lit("deletion").alias("update_type"))
    a = snapshot.additions(prev, latest).select("doc_id", "chapter", F.lit("new").alias("update_type"))
    return d.unionByName(a)


_EVENT_LABELS = [("click", "Click"), ("error", "Error"), ("purchase", "Purchase"), ("signup", "Signup"),
                 ("view", "View")]
_SUMMARY_SQL = """
summary AS (SELECT CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS total,
                   concat('Click: ', sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END),
                          ', Error: ', sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END),
                          ', Purchase: ', sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END),
                          ', Signup: ', sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END),
                          ', View: ', sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END)) AS details
            FROM events GROUP BY CAST(ts AS DATE))"""


def _summary(spark, sf):
    ev = read_table(spark, sf, "events", ["ts", "event_type"])
    return feed.daily_summary(ev, "ts", "event_type", _EVENT_LABELS)


@query("daily_summary", with_ctes(_SUMMARY_SQL, "SELECT day, total, details FROM summary"))
def q_daily_summary(spark, sf):
    """``Label: n, ...`` per day."""
    return _summary(spark, sf)


@query("metrics_log", with_ctes(_SUMMARY_SQL, f"""
, rows AS (SELECT 'daily report' AS metric_type, details, CAST(1 AS BIGINT) AS metric,
                 strftime(day, '%Y-%m-%d') AS date FROM summary),
log AS (SELECT * FROM rows WHERE date <= '{RUN_DATE}')
SELECT * FROM log
UNION ALL
SELECT DISTINCT r.* FROM rows r WHERE r.metric > 0
  AND NOT EXISTS (SELECT 1 FROM log l WHERE l.date = r.date AND l.details = r.details)""".replace("\n, rows", ",\nrows")))
def q_metrics_log(spark, sf):
    """K3: idempotent append of the daily metrics rows to a log already holding the first half."""
    rows = report.metrics_rows(_summary(spark, sf), "daily report")
    log = rows.where(F.col("date") <= RUN_DATE)
    return report.metrics_append(log, rows)


@query("aligned_paragraphs", with_ctes(PARAGRAPH_CTES, """
SELECT pr.manual, pr.chapter, a.doc_id, a.pos, coalesce(a.prev_text, '') AS prev_text,
       coalesce(a.curr_text, '') AS curr_text, a.status
FROM pairs a JOIN prev pr ON a.doc_id = pr.doc_id
WHERE a.doc_id IN (SELECT p.doc_id FROM prev p JOIN latest l ON p.doc_id = l.doc_id WHERE p.text <> l.text)"""))
def q_aligned_paragraphs(spark, sf):
    """K4: side-by-side rows of every changed document, ready for ``partitionBy(manual)``."""
    prev, latest = _pair(spark, sf)
    pairs = paragraphs.pair_in_row(snapshot.changed_pairs(prev, latest))
    return pairs.select("manual", "chapter", "doc_id", "pos",
                        F.coalesce("prev_text", F.lit("")).alias("prev_text"),
                        F.coalesce("curr_text", F.lit("")).alias("curr_text"), "status")


# =============================================================================
# Windows: W5, W6 (W1-W4, W7 are covered above)
# =============================================================================
@query("look_ahead_status", with_ctes(PARAGRAPH_CTES, """
, pn AS (SELECT doc_id, pos, text, lead(text) OVER (PARTITION BY doc_id ORDER BY pos) AS nxt FROM pp),
ln AS (SELECT doc_id, pos, text, lead(text) OVER (PARTITION BY doc_id ORDER BY pos) AS nxt FROM lp)
SELECT a.doc_id, a.pos, a.text AS prev_text, b.text AS curr_text,
       CASE WHEN a.text = b.text THEN 'same' WHEN a.nxt = b.text THEN 'deleted'
            WHEN a.text = b.nxt THEN 'inserted' ELSE 'changed' END AS status
FROM pn a JOIN ln b ON a.doc_id = b.doc_id AND a.pos = b.pos""".replace("\n, pn", ",\npn")))
def q_look_ahead_status(spark, sf):
    """One-row look-ahead alignment (lead read in place from the document's array)."""
    pp, lp = _paras(spark, sf, with_next=True)
    return paragraphs.look_ahead_status(pp, lp)


@query("conversation_look_ahead", """
WITH prev_turns AS (SELECT conv_id, turn, text FROM conversations),
next_turns AS (SELECT conv_id, turn, CASE WHEN turn = 0 THEN replace(upper(text), 'ẞ', 'SS') ELSE text END AS text
               FROM conversations),
a AS (SELECT conv_id, turn, text, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS nxt FROM prev_turns),
b AS (SELECT conv_id, turn, text, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS nxt FROM next_turns)
SELECT a.conv_id, a.turn, a.text AS prev_text, b.text AS curr_text,
       CASE WHEN a.text = b.text THEN 'same' WHEN a.nxt = b.text THEN 'deleted'
            WHEN a.text = b.nxt THEN 'inserted' ELSE 'changed' END AS status
FROM a JOIN b ON a.conv_id = b.conv_id AND a.turn = b.turn""")
def q_conversation_look_ahead(spark, sf):
    """W5 over a row-per-paragraph source: conversation turns, opening turn edited."""
    conv = read_table(spark, sf, "conversations", ["conv_id", "turn", "text"])
    edited = conv.withColumn("text", F.when(F.col("turn") == 0, F.upper("text")).otherwise(F.col("text")))
    return paragraphs.look_ahead_status_rows(conv, edited, "conv_id", "turn")


@query("deletion_runs", with_ctes(PARAGRAPH_CTES, """
, flagged AS (SELECT pp.doc_id, pp.pos, pp.text,
                    NOT EXISTS (SELECT 1 FROM lp WHERE lp.doc_id = pp.doc_id AND lp.text = pp.text) AS deleted
             FROM pp WHERE pp.text IS NOT NULL),
anchored AS (SELECT *, max(CASE WHEN NOT deleted THEN pos END) OVER (PARTITION BY doc_id ORDER BY pos
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS anchor_pos FROM flagged)
SELECT doc_id, anchor_pos, min(pos) AS start_pos, max(pos) AS end_pos, count(*) AS n_paras,
       list(text ORDER BY pos) AS texts
FROM anchored WHERE deleted GROUP BY doc_id, anchor_pos""".replace("\n, flagged", ",\nflagged")))
def q_deletion_runs(spark, sf):
    """Runs of deleted paragraphs anchored to the last kept paragraph before them."""
    pp, lp = _paras(spark, sf)
    return paragraphs.deletion_runs(pp, lp)


# =============================================================================
# Scalar text functions: D1, D2, D4, D6, D7, D8, D9, D10, D11, D12, D13, D16
# =============================================================================
@query("paragraph_distances", with_ctes(PARAGRAPH_CTES, f"""
SELECT doc_id, pos, CAST({lev('prev_text', 'curr_text')} AS BIGINT) AS lev_distance,
       CAST(abs(length(prev_text) - length(curr_text)) AS BIGINT) AS char_count_diff,
       {lev('prev_text', 'curr_text')} > {SIGNIFICANCE_THRESHOLD} AS above_threshold
FROM pairs WHERE status = 'changed'"""))
def q_paragraph_distances(spark, sf):
    """D1 + D2 + F3 on every changed paragraph pair (code-point distance)."""
    pp, lp = _paras(spark, sf)
    ch = paragraphs.pair_paragraphs(pp, lp, "inner").where(F.col("status") == "changed")
    return ch.select("doc_id", "pos", long_edit_distance("prev_text", "curr_text").alias("lev_distance"),
                     X.length_diff("prev_text", "curr_text").cast("long").alias("char_count_diff"),
                     far_apart("prev_text", "curr_text", SIGNIFICANCE_THRESHOLD).alias("above_threshold"))


@query("title_replacements", with_ctes(SNAPSHOT_CTES, """
SELECT doc_id, replace(replace(replace(title, chapter || ' ', ''), '—', ' '), '’', '''') AS title,
       translate(title, 'ae', 'AE') AS shouted FROM latest"""))
def q_title_replacements(spark, sf):
    """Literal replacements (chapter prefix, dash, curly quote) and a translate."""
    latest = _pair(spark, sf)[1]
    t = F.replace(F.replace(F.replace("title", F.concat("chapter", F.lit(" ")), F.lit("")), F.lit("—"), F.lit(" ")),
                  F.lit("’"), F.lit("'"))
    return latest.select("doc_id", t.alias("title"), F.translate("title", "ae", "AE").alias("shouted"))


@query("url_parts", r"""
SELECT page_id,
       nullif(regexp_extract(url, '^[A-Za-z]+://[^/]+/([^/?#]*)', 1), '') AS part1,
       nullif(regexp_extract(url, '^[A-Za-z]+://[^/]+/([^/?#]*)/([^/?#]*)', 2), '') AS part2,
       regexp_extract(url, '^[A-Za-z]+://([^/]+)', 1) AS host
FROM pages""")
def q_url_parts(spark, sf):
    """First and second path part and host of every page link."""
    pages = read_pages(spark, sf)
    return pages.select("page_id", H.url_part("url", 1).alias("part1"), H.url_part("url", 2).alias("part2"),
                        F.regexp_extract("url", r"^[A-Za-z]+://([^/]+)", 1).alias("host"))


@query("cleaned_bodies", r"""
SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
       regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
         regexp_extract(html, '(?is)<article>(.*?)</article>', 1),
         '<br>', '<br/>', 'g'), '<hr>', '<hr/>', 'g'), '&lt;', '<', 'g'), '&gt;', '>', 'g'),
         '<ul><li></ul>', '', 'g'), '<u>', '', 'g'), '</u>', '', 'g'), '<img ([^>]*)>', '<img \1 />', 'g'),
         '”', '"', 'g'), '<span [^>]*>', '<span>', 'g'), '<span>', '', 'g'), '</span>', '', 'g') AS cleaned
FROM pages""")
def q_cleaned_bodies(spark, sf):
    """The ordered redline clean-up chain over every page body."""
    pages = read_pages(spark, sf)
    return pages.select("page_id", H.clean_redline(H.article_body("html")).alias("cleaned"))


@query("title_case_titles", r"""
SELECT page_id,
       array_to_string(list_transform(string_split(lower(replace(t, '-', ' ')), ' '),
                                      lambda w: replace(upper(left(w, 1)), 'ẞ', 'Ss') || substr(w, 2)), ' ') AS title_case,
       replace(upper(t), 'ẞ', 'SS') AS upper_title
FROM (SELECT page_id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS t FROM pages)""")
def q_title_case_titles(spark, sf):
    """``replace('-', ' ')`` + word capitalisation, and ``upper``."""
    pages = read_pages(spark, sf)
    t = F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1)
    return pages.select("page_id", X.title_case_words(t).alias("title_case"), F.upper(t).alias("upper_title"))


@query("feed_dates", """
SELECT event_id, CAST(ts AS DATE) AS published FROM events""")
def q_feed_dates(spark, sf):
    """D8 + D14: feed date text (padded as scraped) squeezed and parsed with ``d MMMM yyyy``."""
    ev = read_table(spark, sf, "events", ["event_id", "ts"])
    scraped = F.concat(F.lit("  \n   "), F.date_format("ts", "d MMMM yyyy"), F.lit("\n    "))
    return ev.select("event_id", feed.feed_date(scraped).alias("published"))


ESCAPED_SQL = """
escaped AS (SELECT doc_id, pos, status, replace(replace(replace(prev_text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS p,
                   replace(replace(replace(curr_text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS c
            FROM pairs WHERE doc_id IN (SELECT p.doc_id FROM prev p JOIN latest l ON p.doc_id = l.doc_id WHERE p.text <> l.text)),
redlines AS (SELECT doc_id, string_agg(CASE WHEN status = 'same' THEN p WHEN status = 'inserted' THEN '<ins>' || c || '</ins>'
                      WHEN status = 'deleted' THEN '<del>' || p || '</del>'
                      ELSE '<del>' || p || '</del><ins>' || c || '</ins>' END, chr(10) ORDER BY pos) AS redline
             FROM escaped GROUP BY doc_id)"""


@query("paragraph_redline", with_ctes(PARAGRAPH_CTES + "," + ESCAPED_SQL, "SELECT doc_id, redline FROM redlines"))
def q_paragraph_redline(spark, sf):
    """D9 paragraph form: per changed document, ``<del>``/``<ins>`` markup joined in order."""
    prev, latest = _pair(spark, sf)
    pairs = paragraphs.pair_in_row(snapshot.changed_pairs(prev, latest))
    return redline.document_redline(redline.paragraph_markup(pairs))


@query("word_redline", None)
def q_word_redline(spark, sf):
    """D9 word form (Arrow UDF on changed pairs only); checked against difflib in tests."""
    pp, lp = _paras(spark, sf)
    pairs = paragraphs.pair_paragraphs(pp, lp, "inner").where(F.col("status") == "changed")
    return redline.word_markup(pairs).select("doc_id", "pos", "markup")


@query("pages_without_nav", r"""
SELECT page_id, regexp_replace(html, '(?is)<nav\b.*?</nav>', '', 'g') AS html FROM pages""")
def q_pages_without_nav(spark, sf):
    """Every page without its ``<nav>`` elements."""
    return read_pages(spark, sf).select("page_id", H.strip_navigation("html").alias("html"))


@query("underline_cleaned", None)
def q_underline_cleaned(spark, sf):
    """Angle brackets removed inside every ``<u>`` of the word redline."""
    pp, lp = _paras(spark, sf)
    pairs = paragraphs.pair_paragraphs(pp, lp, "inner").where(F.col("status") == "changed")
    marked = redline.word_markup(pairs)
    u = F.regexp_replace("markup", r"<(/?)(ins|del)>", "<$1u>")
    return marked.select("doc_id", "pos", redline.clean_underlined(u).alias("cleaned"))


@query("page_text", r"""
SELECT page_id,
  replace(replace(replace(replace(replace(
    regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>', '', 'g'),
                                  '(?is)<style\b.*?</style>', '', 'g'), '(?s)<[^>]*>', '', 'g'),
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS text
FROM pages""")
def q_page_text(spark, sf):
    """Text rendering of every page (code and tags removed, entities decoded)."""
    return read_pages(spark, sf).select("page_id", H.html_to_text("html").alias("text"))


@query("paragraph_alignment", None)
def q_paragraph_alignment(spark, sf):
    """Alignment of changed documents by matching blocks (Arrow UDF on the joined pair); tested against difflib."""
    prev, latest = _pair(spark, sf)
    return redline.align_documents(snapshot.changed_pairs(prev, latest))


@query("conversation_alignment", None)
def q_conversation_alignment(spark, sf):
    """D16 over row-per-paragraph input: cogrouped alignment of conversation turns."""
    conv = read_table(spark, sf, "conversations", ["conv_id", "turn", "text"])
    old = conv.select(F.col("conv_id").alias("doc_id"), F.col("turn").cast("int").alias("pos"), "text")
    new = old.where(F.col("pos") != 1)
    return redline.align_paragraphs(old, new)


# =============================================================================
# Term search: J14, J14b, A6, W4
# =============================================================================
_TERMS_SQL = """
terms AS (SELECT item_id AS term_idx, text AS term FROM benchmark WHERE length(text) > 0),
hits AS (SELECT d.doc_id, t.term_idx, t.term,
                CAST((length(d.text) - length(replace(d.text, t.term, ''))) // length(t.term) AS BIGINT) AS n_hits
         FROM documents d JOIN terms t ON contains(d.text, t.term))"""


@query("term_hits", with_ctes(_TERMS_SQL, """
SELECT doc_id, term_idx, term, n_hits,
       CAST(sum(n_hits) OVER (PARTITION BY doc_id ORDER BY term_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS BIGINT) AS running_hits
FROM hits"""))
def q_term_hits(spark, sf):
    """J14 + A6 + W4: benchmark passages found in documents, hits and running hits."""
    docs = read_table(spark, sf, "documents", ["doc_id", "text"])
    terms = search.terms_from_items(read_table(spark, sf, "benchmark", ["item_id", "text"]))
    return search.term_hits(docs, terms)


@query("term_hits_kgram", with_ctes(_TERMS_SQL, "SELECT doc_id, term_idx, n_hits FROM hits"))
def q_term_hits_kgram(spark, sf):
    """J14 + A6: hits only, without the running total."""
    docs = read_table(spark, sf, "documents", ["doc_id", "text"])
    terms = search.terms_from_items(read_table(spark, sf, "benchmark", ["item_id", "text"]))
    return search.term_hits_kgram(docs, terms).drop("term")


@query("term_tokens", r"""
WITH terms AS (SELECT min(item_id) AS term_idx, token AS term FROM (
                 SELECT item_id, unnest(regexp_extract_all(text, '\p{L}+', 0)) AS token FROM benchmark) GROUP BY token),
toks AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '\p{L}+', 0)) AS token FROM documents)
SELECT toks.doc_id, terms.term_idx, toks.token AS term FROM toks JOIN terms ON toks.token = terms.term""")
def q_term_tokens(spark, sf):
    """All tokens of the benchmark items that are a whole token of a document, as an equi-join on the token."""
    docs = read_table(spark, sf, "documents", ["doc_id", "text"])
    bench = read_table(spark, sf, "benchmark", ["item_id", "text"])
    terms = search.tokens_from_items(bench, r"\p{L}+")
    return search.term_tokens(docs, terms, token_pattern=r"\p{L}+")


@query("term_locations", """
WITH terms AS (SELECT item_id AS term_idx, text AS term FROM benchmark WHERE length(text) > 0),
m AS (SELECT doc_id, text, source || '/' || upper(lang) || '_ch_' || CAST(doc_id AS VARCHAR) || '.xml' AS member
      FROM documents),
g AS (SELECT DISTINCT d.source AS grp FROM labels l JOIN documents d ON l.doc_id = d.doc_id WHERE l.quality = 1),
hits AS (SELECT m.doc_id, t.term_idx, t.term, m.member,
                CAST((length(m.text) - length(replace(m.text, t.term, ''))) // length(t.term) AS BIGINT) AS n_hits
         FROM m JOIN terms t ON contains(m.text, t.term)
         WHERE regexp_extract(m.member, '([^/]*)/([^./]*\\.xml)', 1) IN (SELECT grp FROM g))
SELECT doc_id, term_idx, term, n_hits,
       CAST(sum(n_hits) OVER (PARTITION BY doc_id ORDER BY term_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS BIGINT) AS running_hits,
       regexp_extract(member, '([^/]*)/([^./]*\\.xml)', 1) AS grp,
       regexp_extract(member, '([^/]*)/([^./]*\\.xml)', 2) AS filename,
       regexp_extract(member, '_([0-9]*)\\.xml', 1) AS doc_ref,
       nullif(regexp_extract(regexp_extract(member, '([^/]*)/([^./]*\\.xml)', 2), '^([^0-9_]+)_[^0-9]+_', 1), '') AS area
FROM hits""")
def q_term_locations(spark, sf):
    """Term-location job: group lookup, term hits, path parts."""
    docs = read_table(spark, sf, "documents", ["doc_id", "source", "lang", "text"])
    labels = read_table(spark, sf, "labels", ["doc_id", "quality"])
    groups = labels.where("quality = 1").join(docs.select("doc_id", "source"), "doc_id").select(
        F.col("source").alias("grp"))
    terms = search.terms_from_items(read_table(spark, sf, "benchmark", ["item_id", "text"]))
    return term_locations.locations(term_locations.member_paths(docs), groups, terms).select(
        "doc_id", "term_idx", "term", "n_hits", "running_hits", "grp", "filename", "doc_ref", "area")


# =============================================================================
# Streaming jobs, batch form: T2, T3 (T1, T4 run as streams in the tests)
# =============================================================================
@query("first_event_per_user_type_day", """
SELECT user_id, event_type, CAST(ts AS DATE) AS day, min(ts) AS first_ts, count(*) AS n
FROM events GROUP BY user_id, event_type, CAST(ts AS DATE)""")
def q_first_event_per_user_type_day(spark, sf):
    """T2 in batch: one update per key and day (first one kept)."""
    ev = read_table(spark, sf, "events", ["user_id", "event_type", "ts"])
    return ev.groupBy("user_id", "event_type", F.to_date("ts").alias("day")).agg(
        F.min("ts").alias("first_ts"), F.count(F.lit(1)).alias("n"))


@query("daily_type_counts", """
SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY CAST(ts AS DATE), event_type""")
def q_daily_type_counts(spark, sf):
    """T3 in batch: rows per type per day."""
    ev = read_table(spark, sf, "events", ["ts", "event_type"])
    return change_feed.daily_counts_batch(ev, "event_type")


# The jobs, streams and published tables register themselves in the same registry.
from palimpsest.plans import catalog_jobs  # noqa: E402,F401
