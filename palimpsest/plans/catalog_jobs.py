"""Queries of the daily jobs, the streams and the published tables, in the registry of :mod:`palimpsest.plans.catalog`."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.constants import SIGNIFICANCE_THRESHOLD, WITHHELD_PHRASES
from palimpsest.functions import html as H
from palimpsest.functions import markup
from palimpsest.functions.text import contains_any
from palimpsest.operators import feed, paragraphs, redline, relevance, search, snapshot
from palimpsest.plans import daily_jobs, document_changes, paragraph_changes, term_locations
from palimpsest.plans.catalog import (CASCADE_SQL, ESCAPED_SQL, PAIRED_LOG_SQL, REFS_SQL, RUN_DATE, _pair, _refs, _status,
                                      _STATUS_SQL, q_changes_union, query)
from palimpsest.plans.oracle import LOG_CTES, PARAGRAPH_CTES, SNAPSHOT_CTES, lev, with_ctes
from palimpsest.session import ensure_checkpoint_dir
from palimpsest.sinks import METRICS, metrics_batch_writer
from palimpsest.sinks.ledger import LedgerTable
from palimpsest.sources import xml
from palimpsest.sources.snapshots import newest_logs
from palimpsest.sources.tables import read_pages, read_table
from palimpsest.streaming import change_feed


def _folder(spark, name: str) -> str:
    """A fresh folder in the shared place of checkpoints."""
    return f"{ensure_checkpoint_dir(spark)}/{name}/{uuid.uuid4().hex}"


# =============================================================================
# Redlines that can be published: F15, D6
# =============================================================================
def _broken(text, k):
    """The test redlines by the document's residue of 4: one element, no root, an open tag, a bare ampersand."""
    return (F.when(k == 0, F.concat(F.lit("<p>"), text, F.lit("</p>"))).when(k == 1, F.concat(text, F.lit("<hr/>")))
            .when(k == 2, F.concat(text, F.lit("<b>"))).otherwise(F.concat(F.lit("<p>"), text, F.lit(" & </p>"))))


@query("repaired_redlines", with_ctes(PARAGRAPH_CTES + "," + ESCAPED_SQL, """
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'ok' WHEN 1 THEN 'wrapped' ELSE 'dead' END AS outcome,
       CASE doc_id % 4 WHEN 2 THEN 'unbalanced tags' WHEN 3 THEN 'bare ampersand' END AS defect,
       CASE doc_id % 4 WHEN 0 THEN '<p>' || redline || '</p>' WHEN 1 THEN '<div>' || redline || '<hr/></div>' WHEN 2 THEN redline || '<b>'
                       ELSE '<p>' || redline || ' & </p>' END AS redline
FROM redlines"""))
def q_repaired_redlines(spark, sf):
    """F15 (+ D9): redlines of changed documents, some broken by rule: kept, wrapped once, or dead letters."""
    prev, latest = _pair(spark, sf)
    red = redline.document_redline(redline.paragraph_markup(paragraphs.pair_in_row(snapshot.changed_pairs(prev, latest))))
    broken = red.withColumn("redline", _broken(F.col("redline"), F.col("doc_id") % 4))
    return redline.repaired(broken).select("doc_id", "outcome", "defect", "redline")


_KNOWN = "(?is)^/?(?:" + "|".join(markup.KNOWN_TAGS) + r""")(?:\s(?:"[^"]*"|''[^'']*''|[^<>"''])*)?/?>"""


@query("debracketed_bodies", rf"""
WITH b AS (SELECT page_id, replace(regexp_extract(html, '(?is)<article>(.*?)</article>', 1), '</p>',
                  ' <TeamA page_' || page_id || ' <5x5@mail.example. (X)></p>') AS body FROM pages),
s AS (SELECT page_id, string_split(body, '<') AS parts FROM b)
SELECT page_id, array_to_string(list_transform(parts, lambda p, i: CASE
         WHEN i > 1 AND regexp_matches(p, '{_KNOWN}')
         THEN '<' || regexp_extract(p, '{_KNOWN}', 0) || replace(regexp_replace(p, '{_KNOWN}', ''), '>', '')
         ELSE replace(p, '>', '') END), '') AS cleaned
FROM s""")
def q_debracketed_bodies(spark, sf):
    """Page bodies with planted stray brackets; known tags stay, all other brackets go."""
    planted = F.concat(F.lit(" <TeamA page_"), F.col("page_id").cast("string"), F.lit(" <5x5@mail.example. (X)></p>"))
    body = F.replace(H.article_body("html"), F.lit("</p>"), planted)
    return read_pages(spark, sf).select("page_id", markup.strip_stray_brackets(body).alias("cleaned"))


# =============================================================================
# Updates-feed job (C2): J12, P6, P4, F7, F8, F9, F3, D7
# =============================================================================
_FEED_SQL = rf"""
raw AS (SELECT page_id, url, replace(html, '<article>', CASE WHEN page_id % 7 = 3 THEN '<article><p>Page Archived</p>' ELSE '<article>' END) AS html,
               regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title,
               TIMESTAMP '{RUN_DATE} 00:00:00' + to_seconds(page_id % 86400) - to_days(CASE WHEN page_id % 3 = 2 THEN 1 ELSE 0 END) AS ts,
               nullif(regexp_extract(url, '^[A-Za-z]+://[^/]+/([^/?#]*)', 1), '') AS manual,
               nullif(regexp_extract(url, '^[A-Za-z]+://[^/]+/([^/?#]*)/([^/?#]*)', 2), '') AS chapter
        FROM pages),
bodies AS (SELECT *, regexp_extract(regexp_replace(html, '(?is)<nav\b.*?</nav>', '', 'g'), '(?is)<article>(.*?)</article>', 1) AS body FROM raw),
today AS (SELECT url, manual, chapter, arg_max(title, struct_pack(a := ts, b := title)) AS title FROM bodies
          WHERE ts >= TIMESTAMP '{RUN_DATE} 00:00:00' AND manual IS NOT NULL AND chapter IS NOT NULL AND contains(url, '.example.')
          GROUP BY url, manual, chapter),
fetched AS (SELECT url, max(body) AS body FROM bodies GROUP BY url),
versions AS (SELECT manual, chapter, DATE '{RUN_DATE}' - 3 AS day, 'first ' || body AS body FROM bodies WHERE page_id % 4 = 1
             UNION ALL SELECT manual, chapter, DATE '{RUN_DATE}' - 1, CASE WHEN page_id % 8 = 1 THEN replace(body, 'e', 'ee') ELSE body || '.' END
             FROM bodies WHERE page_id % 4 = 1),
newest AS (SELECT manual, chapter, arg_max(body, struct_pack(a := day, b := body)) AS prev_body FROM versions
           WHERE manual IS NOT NULL AND chapter IS NOT NULL GROUP BY manual, chapter),
cls AS (SELECT t.*, f.body, n.prev_body,
               CASE WHEN n.manual IS NOT NULL THEN 'change' WHEN contains(f.body, 'content has been withheld because of exemptions in the Freedom of Information Act')
                         OR contains(f.body, 'Page Archived') THEN 'deletion' ELSE 'new' END AS update_type
        FROM today t JOIN fetched f USING (url) LEFT JOIN newest n ON t.manual = n.manual AND t.chapter = n.chapter)"""


def _rendered(col: str) -> str:
    """The text of a body, as SQL."""
    out = col
    for pattern in (r"(?is)<script\b.*?</script>", r"(?is)<style\b.*?</style>", r"(?s)<[^>]*>"):
        out = f"regexp_replace({out}, '{pattern}', '', 'g')"
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        out = f"replace({out}, '{entity}', '{char}')"
    return rf"regexp_replace({out}, '\n+', chr(10), 'g')"


def _feed(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Feed rows, fetched pages and an archive of three versions of some chapters, all from ``pages``."""
    pid = F.col("page_id")
    html = F.when(pid % 7 == 3, F.replace("html", F.lit("<article>"), F.lit("<article><p>Page Archived</p>"))).otherwise(F.col("html"))
    pages = read_pages(spark, sf).select("page_id", "url", html.alias("html"))
    ts = F.timestamp_seconds(F.unix_timestamp(F.lit(f"{RUN_DATE} 00:00:00")) + pid % 86400 - F.when(pid % 3 == 2, 86400).otherwise(0))
    rows = pages.select(ts.alias("ts"), "url", F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1).alias("title"))
    stored = daily_jobs.page_bodies(pages).where(pid % 4 == 1).select(
        "page_id", H.url_part("url", 1).alias("manual"), H.url_part("url", 2).alias("chapter"), "body")

    def version(days: int, body) -> DataFrame:
        day = F.date_format(F.date_sub(F.to_date(F.lit(RUN_DATE)), days), "yyyyMMdd")
        return stored.select("manual", "chapter", F.concat_ws("-", F.col("chapter"), day).alias("version_key"), body.alias("body"))
    edited = F.when(pid % 8 == 1, F.replace("body", F.lit("e"), F.lit("ee"))).otherwise(F.concat("body", F.lit(".")))
    archive = version(3, F.concat(F.lit("first "), "body")).unionByName(version(1, edited)).unionByName(version(0, F.lit("of the run date")))
    return rows, pages.select("url", "html"), archive


@query("feed_updates", with_ctes(_FEED_SQL, f"""
SELECT array_to_string(list_transform(string_split(lower(replace(manual, '-', ' ')), ' '),
                                      lambda w: replace(upper(left(w, 1)), 'ẞ', 'Ss') || substr(w, 2)), ' ') AS manual,
       upper(chapter) AS chapter, title, update_type, '<a href="' || url || '" target="_blank">View</a>' AS source_link,
       '<a href="' || manual || '/' || chapter || '-' || strftime(DATE '{RUN_DATE}', '%Y%m%d') || '.html" target="_blank">View</a>' AS archive_link,
       CASE WHEN update_type <> 'change' THEN true
            WHEN abs(length({_rendered('prev_body')}) - length({_rendered('body')})) > {SIGNIFICANCE_THRESHOLD} THEN true
            ELSE {lev(_rendered('prev_body'), _rendered('body'))} > {SIGNIFICANCE_THRESHOLD} END AS above_threshold,
       chapter || '-' || strftime(DATE '{RUN_DATE}', '%Y%m%d') AS version_key, strftime(DATE '{RUN_DATE}', '%d-%m-%Y') AS report_date
FROM cls"""))
def q_feed_updates(spark, sf):
    """The updates-feed job's published records, classified against an archive of dated versions."""
    return daily_jobs.updates_feed_job(*_feed(spark, sf), RUN_DATE, marker=".example.")["updates"]


@query("feed_metrics", with_ctes(_FEED_SQL, f"""
SELECT 'updates feed' AS metric_type, 'Updates: ' || count(*) AS details, CAST(1 AS BIGINT) AS metric, '{RUN_DATE}' AS date
FROM cls HAVING count(*) > 0"""))
def q_feed_metrics(spark, sf):
    """C2 + A7: the updates-feed job's row of the metrics log."""
    return daily_jobs.updates_feed_job(*_feed(spark, sf), RUN_DATE, marker=".example.")["metrics"]


_CRAWL_SQL = f"""
reported AS (SELECT doc_id, update_type, replace(title, '"', '''') AS title, manual, chapter,
                    CASE WHEN doc_id % 9 = 8 THEN 'https://manuals.example.org/' || lower(chapter)
                         ELSE 'https://manuals.example.org/' || manual || '/' || lower(chapter) END AS uri
             FROM status WHERE update_type <> 'same'),
fetched AS (SELECT doc_id FROM latest WHERE doc_id % 9 <> 7),
done AS (SELECT r.*, p.text AS prev_text, l.text AS curr_text FROM reported r LEFT JOIN prev p USING (doc_id) LEFT JOIN latest l USING (doc_id)
         WHERE doc_id % 9 <> 8 AND (update_type = 'deletion' OR doc_id IN (SELECT doc_id FROM fetched)))"""


def _crawl(spark, sf):
    """Report rows of two days, fetched pages and the archive for the crawl-report job, from the snapshot pair.

    Some links are of the wrong kind and some pages were not fetched, by the
    document's residue of 9; yesterday's report holds some rows again.
    """
    prev, latest = _pair(spark, sf)
    st = _status(spark, sf).where(F.col("update_type") != "same")
    rows = xml.explode_crawl_report(xml.parse_crawl_report_column(xml.document_report_xml(st)))
    wrong = F.regexp_replace("uri", "/[^/]*(/[^/]*)$", "$1")
    rows = rows.withColumn("uri", F.when(F.col("doc_id") % 9 == 8, wrong).otherwise(F.col("uri")))
    today, day_before = (rows.withColumn("report_date", F.date_sub(F.to_date(F.lit(RUN_DATE)), n)) for n in (0, 1))
    reports = today.unionByName(day_before.where(F.col("doc_id") % 2 == 0)).drop("doc_id")
    page = lambda df: df.select(
        F.concat(F.lit("https://manuals.example.org/"), F.col("manual"), F.lit("/"), F.lower("chapter")).alias("uri"),
        F.concat(F.lit("<nav>of the day</nav>"), "text").alias("text"))
    return reports, page(latest.where(F.col("doc_id") % 9 != 7)), page(prev)


@query("crawl_report_changes", with_ctes(SNAPSHOT_CTES + "," + _STATUS_SQL + "," + _CRAWL_SQL, f"""
SELECT array_to_string(list_transform(string_split(lower(replace(manual, '-', ' ')), ' '),
                                      lambda w: replace(upper(left(w, 1)), 'ẞ', 'Ss') || substr(w, 2)), ' ') AS manual,
       chapter, title, update_type, '<a href="' || uri || '" target="_blank">View</a>' AS source_link,
       '<a href="' || manual || '/' || lower(chapter) || '-' || strftime(DATE '{RUN_DATE}', '%Y%m%d') || '.html" target="_blank">View</a>' AS archive_link,
       CASE WHEN update_type = 'new' THEN true ELSE {lev('prev_text', 'curr_text')} > {SIGNIFICANCE_THRESHOLD} END AS above_threshold,
       lower(chapter) || '-' || strftime(DATE '{RUN_DATE}', '%Y%m%d') AS version_key, strftime(DATE '{RUN_DATE}', '%d-%m-%Y') AS report_date
FROM done WHERE update_type <> 'deletion'"""))
def q_crawl_report_changes(spark, sf):
    """The crawl-report job's published records: newest report, date gate, navigation stripped, F3 on whole texts."""
    return daily_jobs.crawl_report_job(*_crawl(spark, sf), RUN_DATE)["updates"]


@query("crawl_report_processed", with_ctes(SNAPSHOT_CTES + "," + _STATUS_SQL + "," + _CRAWL_SQL, """
SELECT update_type, count(*) AS n_reported, count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM done)) AS n_processed
FROM reported GROUP BY update_type"""))
def q_crawl_report_processed(spark, sf):
    """C1 + Q11: reported and processed rows per update type, with broken links and missing pages among them."""
    return daily_jobs.crawl_report_job(*_crawl(spark, sf), RUN_DATE)["counts"]


# =============================================================================
# Snapshot logs from dated folders: S5, W7
# =============================================================================
@query("changes_from_logs", with_ctes(LOG_CTES + "," + PAIRED_LOG_SQL + "," + CASCADE_SQL, """
SELECT doc_id, chapter, prev_title AS title, k, prev_para, curr_para, n_paras_with_changes,
       char_count_diff, lev_distance FROM firsts"""))
def q_changes_from_logs(spark, sf):
    """S5 + W7: the paragraph comparison run on the newest two of five dated log folders; the others are never read."""
    folder = _folder(spark, "logs")
    plog, llog = paragraph_changes.logs(*_pair(spark, sf))
    stale = plog.withColumn("para", F.lit("an older log"))
    for day, log in (("20240110", stale), ("20240111", stale), ("20240115", llog), ("20240114", plog), ("20240109", stale)):
        log.write.parquet(f"{folder}/log-{day}")
    newest, older = newest_logs(spark, folder, "log-", 2)
    return paragraph_changes.summary_of_logs(spark.read.parquet(older), spark.read.parquet(newest))


# =============================================================================
# Published lists: K2, P3, P7, O1, W2, J7, S6
# =============================================================================
@query("listed_documents", with_ctes(SNAPSHOT_CTES + """,
listed AS (SELECT 'additions' AS section, manual AS source, chapter AS chapter_number, title FROM latest WHERE doc_id NOT IN (SELECT doc_id FROM prev)
           UNION ALL SELECT 'deletions', manual, chapter, title FROM prev WHERE doc_id NOT IN (SELECT doc_id FROM latest))""", """
SELECT section, row_number() OVER (PARTITION BY section ORDER BY chapter_number DESC) AS section_rank, source, chapter_number, title,
       replace(replace('<a href="chapters/' || chapter_number || '.html" target="_blank">View</a>', '—', ' '), '’', '''') AS html,
       '<a href="chapters/' || chapter_number || '.docx" target="_blank">Download</a>' AS tracked_changes
FROM listed"""))
def q_listed_documents(spark, sf):
    """P7 + P3 + O1: the published lists of added and deleted documents, with links and rank."""
    prev, latest = _pair(spark, sf)
    rows = document_changes.listed(snapshot.additions(prev, latest), snapshot.deletions(prev, latest))
    return rows.select("section", "section_rank", "source", "chapter_number", "title", "html", "tracked_changes")


@query("chapter_change_list", with_ctes(LOG_CTES + "," + PAIRED_LOG_SQL + "," + CASCADE_SQL + "," + REFS_SQL, """
SELECT row_number() OVER (ORDER BY f.n_paras_with_changes DESC, f.chapter) AS rank, f.chapter, replace(f.prev_title, 'Previous', '') AS title,
       coalesce(r.found_in, '') AS found_in, f.n_paras_with_changes, 'Click to view' AS link_to_changes
FROM firsts f LEFT JOIN (SELECT pattern, array_to_string(list_sort(list(doc_ref)), ', ') AS found_in FROM refs GROUP BY pattern) r ON f.chapter = r.pattern"""))
def q_chapter_change_list(spark, sf):
    """W2 + J7 + O1: the published chapter list of the paragraph comparison, by number of changed paragraphs."""
    prev, latest = _pair(spark, sf)
    return paragraph_changes.chapter_list(paragraph_changes.chapter_summary(prev, latest, _refs(spark, sf)))


@query("deletions_found_in", with_ctes(LOG_CTES + "," + REFS_SQL, """
SELECT p.key, p.doc_id, p.k, coalesce(r.found_in, '') AS found_in
FROM plog p LEFT JOIN (SELECT pattern, array_to_string(list_sort(list(doc_ref)), ', ') AS found_in FROM refs GROUP BY pattern) r ON p.chapter = r.pattern
WHERE p.key NOT IN (SELECT key FROM llog)"""))
def q_deletions_found_in(spark, sf):
    """J4b + J7: deleted paragraphs with the documents that refer to their chapter."""
    plog, llog = paragraph_changes.logs(*_pair(spark, sf))
    deleted = paragraph_changes.deleted_paragraphs(plog, llog)
    found = relevance.lookup_refs(deleted.select("key", "doc_id", "k", "chapter"), _refs(spark, sf))
    return found.select("key", "doc_id", "k", F.col("doc_info").alias("found_in"))


@query("term_location_records", """
WITH terms AS (SELECT item_id AS term_idx, text AS term FROM benchmark WHERE length(text) > 0),
m AS (SELECT doc_id, CASE WHEN doc_id % 7 = 3 THEN source || '/' || CAST(doc_id AS VARCHAR) || '.xml'
                          ELSE source || '/' || upper(lang) || '_ch_' || CAST(doc_id AS VARCHAR) || '.xml' END AS member,
             CASE WHEN doc_id % 5 = 0 THEN NULL ELSE split_part(text, chr(10), 1) END AS title, text FROM documents),
x AS (SELECT *, coalesce(title, '') || chr(10) || text AS whole FROM m),
g AS (SELECT DISTINCT d.source AS grp FROM labels l JOIN documents d ON l.doc_id = d.doc_id WHERE l.quality = 1),
hits AS (SELECT x.*, t.term_idx, t.term, CAST((length(whole) - length(replace(whole, t.term, ''))) // length(t.term) AS BIGINT) AS n
         FROM x JOIN terms t ON contains(whole, t.term) WHERE regexp_extract(member, '([^/]*)/([^./]*\\.xml)', 1) IN (SELECT grp FROM g))
SELECT coalesce(nullif(regexp_extract(member, '_([0-9]*)\\.xml', 1), ''), 'not found') AS doc_ref, coalesce(nullif(title, ''), 'not found') AS doc_title,
       coalesce(nullif(regexp_extract(regexp_extract(member, '([^/]*)/([^./]*\\.xml)', 2), '^([^0-9_]+)_[^0-9]+_', 1), ''), 'not found') AS area,
       coalesce(nullif(regexp_extract(member, '([^/]*)/([^./]*\\.xml)', 2), ''), 'not found') AS filename, term AS pattern,
       CAST(sum(n) OVER (PARTITION BY doc_id ORDER BY term_idx ROWS UNBOUNDED PRECEDING) AS BIGINT) AS count
FROM hits""")
def q_term_location_records(spark, sf):
    """S6 + J13 + J14 + W4 + P1: the published term records of XML archive members, title read from the markup, ``not found`` where a part is missing."""
    docs = read_table(spark, sf, "documents", ["doc_id", "source", "lang", "text"])
    labels = read_table(spark, sf, "labels", ["doc_id", "quality"])
    groups = labels.where("quality = 1").join(docs.select("doc_id", "source"), "doc_id").select(F.col("source").alias("grp"))
    number = F.col("doc_id").cast("string")
    name = F.when(F.col("doc_id") % 7 == 3, number).otherwise(F.concat(F.upper("lang"), F.lit("_ch_"), number))
    title = F.when(F.col("doc_id") % 5 != 0, F.concat(F.lit("<kh:document-title>"), markup.escape(F.substring_index("text", "\n", 1)), F.lit("</kh:document-title>")))
    members = docs.select("doc_id", F.concat("source", F.lit("/"), name, F.lit(".xml")).alias("member"),
                          F.concat(F.lit("<doc><!-- kept -->"), F.coalesce(title, F.lit("")), F.lit("\n<body k='>'>"), markup.escape("text"), F.lit("</body></doc>")).alias("xml"))
    terms = search.terms_from_items(read_table(spark, sf, "benchmark", ["item_id", "text"]))
    return term_locations.records(members, groups, terms)


# =============================================================================
# Branches that the tables alone don't reach: F9, F10, D11
# =============================================================================
@query("feed_date_gates", f"""
SELECT CAST(max(ts) AS DATE) AS newest_date, DATE '{RUN_DATE}' AS run_date, 'stale' AS status FROM events HAVING CAST(max(ts) AS DATE) <> DATE '{RUN_DATE}'
UNION ALL SELECT CAST(max(ts) AS DATE), CAST(max(ts) AS DATE), 'ok' FROM events""")
def q_feed_date_gates(spark, sf):
    """the gate on a run date that is stale and on the feed's own newest date."""
    ev = read_table(spark, sf, "events", ["ts"])
    return feed.date_gate(ev, RUN_DATE).unionByName(feed.date_gate(ev, ev.agg(F.to_date(F.max("ts"))).scalar()))


@query("withheld_planted_pages", """
SELECT page_id, page_id % 5 IN (1, 2) OR contains(html, 'content has been withheld because of exemptions in the Freedom of Information Act')
                OR contains(html, 'Page Archived') AS withheld FROM pages""")
def q_withheld_planted_pages(spark, sf):
    """pages with one of the two phrases planted by rule, or neither."""
    phrase = F.when(F.col("page_id") % 5 == 1, F.lit(WITHHELD_PHRASES[0])).when(F.col("page_id") % 5 == 2, F.lit(WITHHELD_PHRASES[1])).otherwise(F.lit(""))
    pages = read_pages(spark, sf).withColumn("html", F.concat("html", phrase))
    return pages.select("page_id", contains_any("html", WITHHELD_PHRASES).alias("withheld"))


@query("underlined_titles", with_ctes(SNAPSHOT_CTES, """
SELECT doc_id, '<p>' || title || '</p><u>' || replace(replace(replace(replace(title || ' <x> &lt;y&gt; ', '&lt;', ''), '&gt;', ''), '<', ''), '>', '')
               || '</u> between <b>1 < 2</b><u>' || chapter || ' ab</u>' AS cleaned
FROM latest"""))
def q_underlined_titles(spark, sf):
    """Brackets planted inside and outside ``<u>`` elements; only those inside go."""
    latest = _pair(spark, sf)[1]
    marked = F.concat(F.lit("<p>"), "title", F.lit("</p><u>"), "title", F.lit(" <x> &lt;y&gt; </u> between <b>1 < 2</b><u>"), "chapter", F.lit(" a&gt;b</u>"))
    return latest.select("doc_id", redline.clean_underlined(marked).alias("cleaned"))


# =============================================================================
# Streaming jobs, run as streams: T1-T4 over files that land in two lots
# =============================================================================
_LANDED_SQL = f"""
first_lot AS (SELECT * FROM events WHERE ts < TIMESTAMP '{RUN_DATE} 12:00:00' AND event_id % 50 <> 0),
second_lot AS (SELECT * FROM events WHERE NOT (ts < TIMESTAMP '{RUN_DATE} 12:00:00' AND event_id % 50 <> 0)),
mark AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 DAY AS first_mark FROM first_lot)"""


def _streamed(spark, sf, run) -> str:
    """Land ``events`` in two lots, the second with rows that come late, and call ``run(stream, folder)`` after each."""
    folder = _folder(spark, "streams")
    ev = read_table(spark, sf, "events", ["event_id", "user_id", "event_type", "ts"])
    early = (F.col("ts") < F.to_timestamp(F.lit(f"{RUN_DATE} 12:00:00"))) & (F.col("event_id") % 50 != 0)
    for k, lot in enumerate((ev.where(early), ev.where(~early))):
        lot.write.parquet(f"{folder}/landing/{k}")
        run(change_feed.event_stream(spark, f"{folder}/landing", ev.schema, max_files=None), folder)
    return folder


@query("first_event_stream", with_ctes(_LANDED_SQL, """
SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM (
  SELECT user_id, event_type, ts FROM first_lot
  UNION ALL SELECT user_id, event_type, ts FROM second_lot, mark WHERE ts > coalesce(first_mark, TIMESTAMP '0001-01-01'))"""))
def q_first_event_stream(spark, sf):
    """T2 as a stream: one update per key and day in watermarked state, stopped and restarted from its checkpoint between the lots.

    Rows later than the watermark (a day behind the newest row of the first lot) are dropped.
    """
    def run(stream, folder):
        first = change_feed.one_per_key_and_day(stream, ["user_id", "event_type"]).select("user_id", "event_type", "day")
        change_feed.run_available(first, "first_event", checkpoint=f"{folder}/checkpoint", out=f"{folder}/out")
    return spark.read.schema("user_id long, event_type string, day date").parquet(f"{_streamed(spark, sf, run)}/out")


@query("metrics_log_stream", with_ctes(_LANDED_SQL + """,
taken AS (SELECT event_type, CAST(ts AS DATE) AS day FROM first_lot
          UNION ALL SELECT event_type, CAST(ts AS DATE) FROM second_lot, mark
          WHERE date_trunc('day', ts) + INTERVAL 1 DAY > coalesce(first_mark, TIMESTAMP '0001-01-01')),
closed AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 DAY AS last_mark FROM events)""", """
SELECT 'daily stream' AS metric_type, event_type || ': ' || count(*) AS details, count(*) AS metric, strftime(day, '%Y-%m-%d') AS date
FROM taken, closed WHERE CAST(day AS TIMESTAMP) + INTERVAL 1 DAY <= last_mark GROUP BY day, event_type"""))
def q_metrics_log_stream(spark, sf):
    """T3 + T4 + K3 as a stream: daily counts of closed days, logged exactly once through the commit ledger, over a restart."""
    def run(stream, folder):
        rows = change_feed.metrics_from_counts(change_feed.daily_counts(stream, "event_type"), "event_type", "daily stream")
        change_feed.run_available(rows, "metrics_log", sink_fn=metrics_batch_writer(LedgerTable(f"{folder}/log", METRICS), "daily"),
                                  checkpoint=f"{folder}/checkpoint")
    table = LedgerTable(f"{_streamed(spark, sf, run)}/log", METRICS)
    return table.read(spark).select("metric_type", "details", "metric", "date")


@query("crawl_report_stream", with_ctes(SNAPSHOT_CTES + "," + _STATUS_SQL + """,
made AS (SELECT update_type, CAST(doc_id AS VARCHAR) AS id, 'https://manuals.example.org/' || manual || '/' || lower(chapter) AS uri,
                CASE WHEN doc_id % 7 = 0 THEN 'unbalanced tags' WHEN doc_id % 7 = 1 THEN 'bare ampersand'
                     WHEN doc_id % 7 = 2 THEN 'no documents' END AS reason
         FROM status WHERE update_type <> 'same')""", """
SELECT CASE WHEN reason IS NULL THEN 'good' ELSE 'bad' END AS kind, CASE WHEN reason IS NULL THEN update_type END AS update_type,
       CASE WHEN reason IS NULL THEN id END AS id, CASE WHEN reason IS NULL THEN uri END AS uri, reason
FROM made"""))
def q_crawl_report_stream(spark, sf):
    """T1 + S4 + F15 as a stream: each report parsed once, good rows and unreadable reports (with the reason) kept, none lost.

    Reports of some documents are broken by rule before they land.
    """
    folder = _folder(spark, "streams")
    k, text = F.col("doc_id") % 7, F.col("report_xml")
    broken = (F.when(k == 0, F.replace(text, F.lit("</report>"), F.lit(""))).when(k == 1, F.replace(text, F.lit("</report>"), F.lit(" & </report>")))
              .when(k == 2, F.lit("<report><added></added></report>")).otherwise(text))
    reports = xml.document_report_xml(_status(spark, sf).where(F.col("update_type") != "same"))
    reports.select(broken.alias("value")).write.text(f"{folder}/landing")
    table = LedgerTable(f"{folder}/reports", change_feed.PARSED_REPORT)
    change_feed.run_available(change_feed.report_text_stream(spark, f"{folder}/landing"), "crawl_reports",
                              sink_fn=change_feed.report_batch_writer(table, "crawl"), checkpoint=f"{folder}/checkpoint")
    return table.read(spark).select("kind", "update_type", "id", "uri", "reason")


@query("published_changes", with_ctes(SNAPSHOT_CTES, """
SELECT doc_id, chapter, 'deletion' AS update_type FROM prev WHERE doc_id NOT IN (SELECT doc_id FROM latest)
UNION ALL
SELECT doc_id, chapter, 'new' AS update_type FROM latest WHERE doc_id NOT IN (SELECT doc_id FROM prev)"""))
def q_published_changes(spark, sf):
    """K1: a report published in a first and a second version, read back as readers see it."""
    table = LedgerTable(_folder(spark, "published"), "doc_id long, chapter string, update_type string")
    changes = q_changes_union(spark, sf)
    table.publish(changes.where(F.col("update_type") == "new"), "changes")
    table.publish(changes, "changes")
    return table.read_newest(spark, "changes")
