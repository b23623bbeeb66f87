"""The two daily jobs, as batch DataFrame plans.

Crawl-report job: newest report -> date gate -> additions and changes ->
pages, navigation stripped -> distance flag -> redline + clean-up + repair ->
published records and tables -> counts -> metrics log row.

Updates-feed job: feed rows of the run date -> link kind -> newest stored
version (new / change / deletion) -> flag -> redline + clean-up + repair ->
published records and per-type tables -> metrics row.

Pages arrive as a table (``page_id, url, html``); fetching is not part of the
engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.constants import REPORT_DATE_FORMAT, SIGNIFICANCE_THRESHOLD, VERSION_DATE_FORMAT, VIEW_LINK, WITHHELD_PHRASES
from palimpsest.functions.html import article_body, clean_redline, strip_navigation
from palimpsest.functions.markup import close_void, strip_stray_brackets
from palimpsest.functions.text import contains_any, exceeds_distance, link_to, title_case_words
from palimpsest.operators import feed


def page_bodies(pages: DataFrame) -> DataFrame:
    """S7 + D10 + M9: page body with navigation removed."""
    return pages.select("page_id", "url", article_body(strip_navigation(F.col("html"))).alias("body"))


def classified_pages(pages: DataFrame, archive: DataFrame) -> DataFrame:
    """F8 + D5 + J12 + F9: link parts and update type per page.

    A page's chapter number is the second path part of its link; the archive
    holds yesterday's documents keyed by ``doc_id``.
    """
    parts = feed.link_parts(page_bodies(pages), "url")
    keyed = parts.withColumn("doc_id", F.col("chapter").try_cast("long"))
    return feed.classify_pages(keyed, archive.select("doc_id"), body="body")


def update_table(classified: DataFrame, run_date: str) -> DataFrame:
    """The update rows as published (manual title-cased, chapter upper)."""
    day = F.to_date(F.lit(run_date))
    return classified.select(
        "page_id", title_case_words("manual").alias("manual"), F.upper("chapter").alias("chapter"),
        "update_type",
        F.concat_ws("-", F.col("chapter"), F.date_format(day, VERSION_DATE_FORMAT)).alias("version_key"),
        F.date_format(day, REPORT_DATE_FORMAT).alias("report_date"))


def update_record(rows: DataFrame, run_date: str) -> DataFrame:
    """The whole published record of an update.

    ``rows``: ``url, manual, chapter, title, update_type, above_threshold``.
    Links go to the page itself and to the run's stored version of it.
    """
    day = F.to_date(F.lit(run_date))
    key = F.concat_ws("-", F.col("chapter"), F.date_format(day, VERSION_DATE_FORMAT))
    return rows.select(
        title_case_words("manual").alias("manual"), F.upper("chapter").alias("chapter"), "title", "update_type",
        link_to("url", VIEW_LINK).alias("source_link"),
        link_to(F.concat("manual", F.lit("/"), key, F.lit(".html")), VIEW_LINK).alias("archive_link"),
        "above_threshold", key.alias("version_key"), F.date_format(day, REPORT_DATE_FORMAT).alias("report_date"))


def newest_versions(archive: DataFrame, run_date: str) -> DataFrame:
    """P6 + J12: each chapter's newest stored version from before the run date: ``manual, chapter, prev_body, prev_version``.

    ``archive``: ``manual, chapter, version_key, body``, any number of versions
    a chapter, their keys ending in ``-yyyyMMdd``. ``max_by`` over the dated
    keys keeps one row a chapter in each task before anything is shuffled; of
    several bodies stored on one day the last in binary order counts. Versions
    whose key has no date, and those of the run date or later, don't.
    """
    day = F.try_to_date(F.regexp_extract("version_key", r"-([0-9]{8})\z", 1), VERSION_DATE_FORMAT)
    dated = archive.withColumn("_day", day).where(F.col("_day") < F.to_date(F.lit(run_date)))
    return dated.groupBy("manual", "chapter").agg(
        F.max_by("body", F.struct("_day", "body")).alias("prev_body"), F.max("_day").alias("prev_version"))


def published_markup(markup: Column) -> Column:
    """D11 + D6: brackets dropped inside ``<u>``, the clean-up chain, stray brackets dropped, void tags closed."""
    from palimpsest.operators.redline import clean_underlined
    return close_void(strip_stray_brackets(clean_redline(clean_underlined(markup))))


def redlined_changes(pairs: DataFrame) -> DataFrame:
    """D9 (paragraph form) + D6 + F3 on paired paragraphs of changed documents."""
    from palimpsest.operators.redline import paragraph_markup
    marked = paragraph_markup(pairs)
    return marked.select("doc_id", "pos", published_markup(F.col("markup")).alias("markup"),
                         exceeds_distance(F.coalesce("prev_text", F.lit("")),
                                          F.coalesce("curr_text", F.lit(""))).alias("above_threshold"))


# Link layout of the crawl reports: https://<host>/<manual>/<chapter>
REPORT_URI_PATTERN = r"^https?://[^/]+/([^/]+)/(.+)$"


def report_of_day(reports: DataFrame, run_date: str, day: str = "report_date") -> DataFrame:
    """S5 + F10: the rows of the newest report, and only if it is the run date's; else no rows (a stale feed stops the job).

    The newest date is a scalar subquery (a partial aggregate), read by every task.
    """
    newest = reports.agg(F.max(day)).scalar()
    return reports.where((F.col(day) == newest) & (newest == F.to_date(F.lit(run_date))))


def crawl_report_job(report_rows: DataFrame, latest: DataFrame, prev: DataFrame, run_date: str) -> dict:
    """The crawl-report daily job over exploded report rows (S4 output).

    ``report_rows``: ``(update_type, id, title, uri)``, and ``report_date``
    where reports of several days come together (:func:`report_of_day` then
    picks the run date's, or none). ``latest`` / ``prev``: page content keyed
    by ``uri`` (``uri, text``), yesterday's archive being ``prev``. A page
    reported twice is one update, with the last title in binary order.
    Returns lazily defined outputs:

    * ``updates`` — the published record (P4, D5, D7) of every addition and
      change that was processed; ``above_threshold`` is F3 on the page texts
      without navigation (D10), TRUE for additions;
    * ``additions``, ``changes`` — rows for the two tables; changes with the
      paragraph redline (D9) cleaned (D6, D11), where it can be read (F15);
    * ``dead`` — changes whose redline stays unreadable;
    * ``counts`` — per update type the number reported and the number
      processed (rows whose link parsed and whose pages were found), Q11;
    * ``metrics`` — the K3 row ``Additions: a, Changes: c, Deletions: d``.
    """
    from palimpsest.functions.distance import long_exceeds
    from palimpsest.operators import paragraphs, redline
    from palimpsest.operators.report import metrics_rows

    if "report_date" in report_rows.columns:
        report_rows = report_of_day(report_rows, run_date)
    part = lambda n: F.nullif(F.regexp_extract("uri", REPORT_URI_PATTERN, n), F.lit(""))
    parsed = report_rows.groupBy("update_type", "uri").agg(F.max(F.struct("title", "id")).alias("_t")).select(
        "update_type", "_t.id", "_t.title", "uri", part(1).alias("manual"), part(2).alias("chapter"))
    ok = parsed.where(F.col("manual").isNotNull() & F.col("chapter").isNotNull())

    # one join a side: a page's presence decides whether a row is processed
    page = lambda df, c: df.select("uri", strip_navigation(F.col("text")).alias(c))
    rows = (ok.join(page(latest, "curr_text"), "uri", "left").join(page(prev, "prev_text"), "uri", "left"))
    kind = F.col("update_type")
    done = rows.where((kind == "deletion") | ((kind == "new") & F.col("curr_text").isNotNull())
                      | ((kind == "change") & F.col("curr_text").isNotNull() & F.col("prev_text").isNotNull()))
    text = lambda c: F.when(kind == "change", F.col(c)).otherwise(F.lit(""))
    scored = (done.withColumn("_far", long_exceeds(text("prev_text"), text("curr_text"), SIGNIFICANCE_THRESHOLD))
              .withColumn("above_threshold", (kind != "change") | F.col("_far")).withColumn("url", F.col("uri")))
    updates = update_record(scored.where(kind != "deletion"), run_date)
    shown = lambda df, *more: df.select(
        "id", title_case_words("manual").alias("manual"), F.upper("chapter").alias("chapter"), "title", "uri", *more)
    ch = scored.where(kind == "change")
    # paragraph redline per changed page: pair by position, mark, clean, join in order
    marked = redline.paragraph_markup(paragraphs.pair_in_row(ch.select(F.col("uri").alias("doc_id"), "prev_text", "curr_text")))
    cleaned = marked.withColumn("markup", published_markup(F.col("markup")))
    red = redline.document_redline(cleaned).withColumnRenamed("doc_id", "uri")
    changes, dead = readable_redlines(ch.join(red, "uri", "left"))

    reported = report_rows.groupBy("update_type").agg(F.count(F.lit(1)).alias("n_reported"))
    processed = done.groupBy("update_type").agg(F.count(F.lit(1)).alias("n_processed"))
    counts = reported.join(processed, "update_type", "left").fillna(0, ["n_processed"])
    labels = [("new", "Additions"), ("change", "Changes"), ("deletion", "Deletions")]
    summary = feed.daily_summary(report_rows.withColumn("ts", F.to_timestamp(F.lit(run_date))),
                                 "ts", "update_type", labels)
    return {"updates": updates, "additions": shown(scored.where(kind == "new")),
            "changes": shown(changes, "above_threshold", "redline"), "dead": shown(dead, "defect", "redline"),
            "counts": counts, "metrics": metrics_rows(summary, "crawl report")}


def readable_redlines(rows: DataFrame, markup: str = "redline") -> tuple[DataFrame, DataFrame]:
    """``(rows whose redline can be published, dead letters)``, see :func:`palimpsest.operators.redline.repaired`."""
    from palimpsest.operators.redline import repaired
    checked = repaired(rows, markup)
    return checked.where(F.col("outcome") != "dead"), checked.where(F.col("outcome") == "dead")


def updates_feed_job(feed_rows: DataFrame, pages: DataFrame, archive: DataFrame, run_date: str,
                     marker: str | None = None) -> dict:
    """The updates-feed daily job.

    ``feed_rows``: ``(ts, url, title)``, newest first in meaning (any order in
    storage); ``pages``: fetched pages ``(url, html)``; ``archive``: stored
    versions ``(manual, chapter, version_key, body)``. Steps: F7 ordered
    take-while on the run date -> F8/D5 link kind and parts -> M9/D10 page body
    -> J12/F9 classification against each chapter's newest version from before
    the run date -> for changes, the F3 flag on the texts (D12; new pages and
    deletions count as above the threshold) and the paragraph redline (D9)
    cleaned of stray brackets (D6) -> the update record (P4, D7, P6) -> F14
    split -> the K3 row ``Updates: n``.

    A link listed twice is one update, with the title of its newest listing
    (the last in binary order of several); a page fetched twice counts with
    the last body in binary order. Links without a fetched page are left out.
    Redlines that stay unreadable after one wrapping go to ``dead`` (F15).
    """
    from palimpsest.functions.distance import long_exceeds
    from palimpsest.functions.html import html_to_text
    from palimpsest.operators import paragraphs, redline
    from palimpsest.operators.report import metrics_rows

    today = (feed.link_parts(feed.take_while_today(feed_rows, run_date), "url", marker)
             .groupBy("url", "manual", "chapter").agg(F.max(F.struct("ts", "title"))["title"].alias("title")))
    body = pages.groupBy("url").agg(F.max(article_body(strip_navigation(F.col("html")))).alias("body"))
    classified = (today.join(body, "url").join(newest_versions(archive, run_date), ["manual", "chapter"], "left")
                  .withColumn("update_type", F.when(F.col("prev_version").isNotNull(), "change")
                              .when(contains_any(F.col("body"), WITHHELD_PHRASES), "deletion")
                              .otherwise("new")))
    is_change = F.col("update_type") == "change"
    text = lambda c: F.when(is_change, F.regexp_replace(html_to_text(c), r"\n+", "\n")).otherwise(F.lit(""))
    texts = (classified.withColumn("curr_text", text(F.col("body"))).withColumn("prev_text", text(F.col("prev_body")))
             .withColumn("_far", long_exceeds("prev_text", "curr_text", SIGNIFICANCE_THRESHOLD))
             .withColumn("above_threshold", ~is_change | F.col("_far")))
    record = update_record(texts, run_date)
    ch = feed.of_type(texts, "change").withColumn("doc_id", F.col("url"))
    marked = redline.paragraph_markup(paragraphs.pair_in_row(ch.select("doc_id", "prev_text", "curr_text")))
    red = redline.document_redline(marked.withColumn("markup", published_markup(F.col("markup"))))
    changes, dead = readable_redlines(ch.join(red, "doc_id", "left"))
    summary = feed.daily_summary(classified.withColumn("ts", F.to_timestamp(F.lit(run_date))),
                                 "ts", "update_type", [("new", "New"), ("change", "Change"),
                                                       ("deletion", "Deletion")])
    total = summary.select("day", F.concat(F.lit("Updates: "), F.col("total").cast("string")).alias("details"))
    return {"updates": record, "changes": changes.select("url", "manual", "chapter", "above_threshold", "redline"),
            "dead": dead.select("url", "manual", "chapter", "defect", "redline"),
            "new": feed.of_type(classified, "new").select("url", "manual", "chapter"),
            "deletions": feed.of_type(classified, "deletion").select("url", "manual", "chapter"),
            "metrics": metrics_rows(total, "updates feed")}
