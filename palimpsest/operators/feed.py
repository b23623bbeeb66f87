"""Daily-job operators: feed filters (F7, F8, F10, F14), page classification
(J12, F9), feed dates (D8, D14), daily summary (A7).

The run date is always an argument; nothing reads the wall clock.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.constants import FEED_DATE_FORMAT, WITHHELD_PHRASES
from palimpsest.functions.html import url_part
from palimpsest.functions.text import contains_any, squeeze_blank_runs


def _date(run_date) -> Column:
    if isinstance(run_date, Column):
        return run_date
    if isinstance(run_date, (_dt.date, _dt.datetime)):
        run_date = run_date.isoformat()[:10]
    return F.to_date(F.lit(run_date))


def today_only(feed: DataFrame, run_date, ts: str = "ts") -> DataFrame:
    """rows published on the run date."""
    return feed.where(F.to_date(ts) == _date(run_date))


def take_while_today(feed: DataFrame, run_date, ts: str = "ts") -> DataFrame:
    """F7, ordered form: newest-first feed read until the first row of another date.

    Equivalent without a global window: keep run-date rows newer than the
    newest row of any other date (a scalar subquery, computed with a partial
    aggregate, so it never funnels the feed through one task).
    """
    other = feed.where(F.to_date(ts) != _date(run_date)).agg(F.max(ts).alias("_cut"))
    cut = other.scalar()
    return feed.where((F.to_date(ts) == _date(run_date))
                      & (cut.isNull() | (F.col(ts) > cut)))


def date_gate(feed: DataFrame, run_date, ts: str = "ts") -> DataFrame:
    """one row ``(newest_date, run_date, status)``; ``ok`` only when they match."""
    newest = feed.agg(F.to_date(F.max(ts)).alias("newest_date"))
    return newest.select("newest_date", _date(run_date).alias("run_date"),
                         F.when(F.col("newest_date") == _date(run_date), "ok")
                         .otherwise("stale").alias("status"))


def feed_date(text) -> Column:
    """D8 + D14: squeeze blank runs, then parse ``d MMMM yyyy``."""
    c = F.col(text) if isinstance(text, str) else text
    return F.to_date(squeeze_blank_runs(c), FEED_DATE_FORMAT)


def link_parts(df: DataFrame, url: str = "url", marker: str | None = None) -> DataFrame:
    """F8 + D5: manual and chapter from the first two path parts of a link.

    Rows whose link lacks ``marker`` (when given) or whose parts do not parse
    are skipped, as a link of the wrong kind.
    """
    out = df.withColumn("manual", url_part(url, 1)).withColumn("chapter", url_part(url, 2))
    cond = F.col("manual").isNotNull() & F.col("chapter").isNotNull()
    if marker:
        cond = cond & F.col(url).contains(marker)
    return out.where(cond)


def classify_pages(pages: DataFrame, archive: DataFrame, body: str = "body",
                   archive_key: str = "doc_id", page_key: str = "doc_id") -> DataFrame:
    """J12 + F9: ``change`` if the chapter is in yesterday's archive, else
    ``deletion`` when the page carries a withheld phrase, else ``new``.

    The archive is reduced to its distinct keys before the left join, so the
    join never multiplies page rows.
    """
    keys = archive.select(F.col(archive_key).alias("_ak")).distinct().withColumn("_in_archive", F.lit(True))
    j = pages.join(keys, pages[page_key] == keys["_ak"], "left")
    update_type = (F.when(F.col("_in_archive"), "change")
                   .when(contains_any(F.col(body), WITHHELD_PHRASES), "deletion")
                   .otherwise("new"))
    return j.withColumn("update_type", update_type).drop("_ak", "_in_archive")


def of_type(df: DataFrame, update_type: str, col: str = "update_type") -> DataFrame:
    """rows of one update type."""
    return df.where(F.col(col) == update_type)


def daily_summary(df: DataFrame, ts: str, kind: str, labels: list[tuple[str, str]]) -> DataFrame:
    """One row per day with ``'<Label>: n, <Label>: n, ...'`` in label order.

    ``labels`` is ``[(value of kind, label), ...]``; conditional sums are one
    partial aggregation.
    """
    aggs = [F.sum(F.when(F.col(kind) == v, 1).otherwise(0)).cast("long").alias(f"_n{i}")
            for i, (v, _) in enumerate(labels)]
    g = df.groupBy(F.to_date(ts).alias("day")).agg(*aggs, F.count(F.lit(1)).cast("long").alias("total"))
    parts = []
    for i, (_, label) in enumerate(labels):
        parts += [F.lit(f"{label}: "), F.col(f"_n{i}").cast("string")]
        if i < len(labels) - 1:
            parts.append(F.lit(", "))
    return g.select("day", "total", F.concat(*parts).alias("details"))
