"""Reports: sections (K2), section counts (A5), metrics log (K3), aligned
per-document table (K4), sorted change list (O1), newest rows (S5/W7/O2).

Order is a sort key or a rank from a range exchange (:func:`ranked`), never a
``row_number`` over an unpartitioned window, which would pull every row into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from palimpsest.constants import CHANGE_INFO, METRICS_DATE_FORMAT, VIEW_LINK
from palimpsest.functions.text import chapter_link
from palimpsest.session import cut_lineage


def change_info(metrics: DataFrame) -> DataFrame:
    """P4 + P3: the human-readable change summary and view link per document."""
    info = F.format_string(CHANGE_INFO, "lev_distance", "char_count_diff", "para_change_count", "para_count")
    return metrics.withColumn("change_info", info).withColumn("html", chapter_link("chapter_number", ".html", VIEW_LINK))


def sorted_changes(metrics: DataFrame) -> DataFrame:
    """O1: changes by distance, largest first; chapter breaks ties.

    A range sort samples its input first, so the metrics are checkpointed: the distances run once.
    """
    return cut_lineage(metrics).orderBy(F.desc("lev_distance"), F.asc("chapter_number"))


def report_sections(changes: DataFrame, additions: DataFrame, deletions: DataFrame) -> DataFrame:
    """K2: one report table — section, projected columns, ``info`` text, and
    the sort key ``sort_key`` (distance for changes, NULL otherwise).

    ``changes`` comes from A3 (after F2); additions / deletions are snapshot
    rows. The table is not globally sorted here: a range sort samples its
    input first, which would run the distance computation twice. The sink
    orders it (:func:`ordered_report`) after the metrics are checkpointed.
    """
    c = change_info(changes).select(F.lit("changes").alias("section"), "source", "chapter_number",
                                    "title", F.col("change_info").alias("info"),
                                    F.col("lev_distance").alias("sort_key"))
    side = lambda df, name: df.select(
        F.lit(name).alias("section"), F.col("manual").alias("source"), F.col("chapter").alias("chapter_number"),
        "title", F.lit(None).cast("string").alias("info"), F.lit(None).cast("long").alias("sort_key"))
    return c.unionByName(side(additions, "additions")).unionByName(side(deletions, "deletions"))


def ordered_report(rows: DataFrame) -> DataFrame:
    """O1 for the report: changes by distance desc; additions, deletions by chapter desc."""
    return rows.orderBy("section", F.desc_nulls_last("sort_key"), F.desc("chapter_number"))


def ranked(df: DataFrame, *order, within: str | None = None, out: str = "rank") -> DataFrame:
    """O1: ``df`` with its global rank (from 1, BIGINT) in ``order``; ``within`` adds ``{within}_rank``.

    One range exchange sorts the rows over all tasks. A row's place inside its
    range is the low part of ``monotonically_increasing_id`` and the range's
    number the high part; ranges are counted, and the counts' running sum (one
    row a range) is joined back, so no task sees more than its range. The
    sorted rows are checkpointed first, because a range exchange samples its
    input anew each time it runs; rows that cost much to make should come
    checkpointed too, as that exchange makes them twice. ``order`` must tell rows apart as far as
    their ranks matter, and with ``within`` must begin with that column: its
    groups are then runs of ranks, and their first ranks (one row a group) are
    subtracted. ``within`` should have few values, such as report sections.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = cut_lineage(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                       .withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = (rows.withColumn("_part", part).join(F.broadcast(offsets), "_part")
              .withColumn(out, F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1)
              .drop("_part", "_before", "_at"))
    if within is None:
        return placed
    first = placed.groupBy(F.col(within).alias("_group")).agg(F.min(out).alias("_first"))
    return (placed.join(F.broadcast(first), placed[within].eqNullSafe(first["_group"]))
            .withColumn(f"{within}_rank", F.col(out) - F.col("_first") + 1).drop("_group", "_first"))


def ranked_changes(metrics: DataFrame) -> DataFrame:
    """O1: the change list with its rank by distance, largest first; chapter and key break ties."""
    return ranked(cut_lineage(metrics), F.desc("lev_distance"), F.asc("chapter_number"), F.asc("doc_id"))


def ranked_report(rows: DataFrame) -> DataFrame:
    """O1 for the report (K2): rank over all sections, and within each as :func:`ordered_report` sorts it."""
    return ranked(cut_lineage(rows), F.asc("section"), F.desc_nulls_last("sort_key"), F.desc("chapter_number"), F.asc("source"), within="section")


def section_counts(report: DataFrame, by_team: DataFrame | None = None) -> DataFrame:
    """A5: rows per section, plus an ``ALL`` total (rollup); per team when given.

    ``by_team`` is the report joined to teams (J11) with a ``team`` column.
    """
    if by_team is None:
        g = report.rollup("section").agg(F.count(F.lit(1)).alias("n"))
        return g.select(F.coalesce("section", F.lit("ALL")).alias("section"), "n")
    g = by_team.rollup("team", "section").agg(F.count(F.lit(1)).alias("n")).where(F.col("team").isNotNull())
    return g.select("team", F.coalesce("section", F.lit("ALL")).alias("section"), "n")


SECTIONS = ["changes", "additions", "deletions"]


def section_matrix(by_team: DataFrame, sections: list[str] = SECTIONS) -> DataFrame:
    """A5 in wide form: a row per team and one for ``ALL``, a column per section and ``total``, 0 where there is none.

    One ``cube`` counts team x section with both totals (``grouping`` tells a
    total from a null value, which reads ``unknown``), and a pivot over the
    fixed ``sections`` turns its few rows into the matrix. Rows of other
    sections count in the totals only.
    """
    label = lambda c: F.when(F.grouping(c) == 1, "ALL").otherwise(F.coalesce(F.col(c), F.lit("unknown")))
    counts = by_team.cube("team", "section").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_level"),
                                                 label("team").alias("_team"), label("section").alias("_section"))
    wide = (counts.groupBy(F.col("_team").alias("team"), (F.col("_level") >= 2).alias("_all"))
            .pivot("_section", [*sections, "ALL"]).agg(F.max("n")))
    return wide.select("team", *[F.coalesce(s, F.lit(0)).alias(s) for s in sections], F.coalesce("ALL", F.lit(0)).alias("total"))


def fresh_metrics(log: DataFrame, new: DataFrame) -> DataFrame:
    """K3: rows of ``new`` with a positive metric whose ``(date, details)`` is not in ``log``, one of each.

    Columns ``metric_type, details, metric, date`` (date as ``yyyy-MM-dd``
    text). Of several new rows for one date and details the least stays.
    """
    return (new.where(F.col("metric") > 0).groupBy("date", "details").agg(F.min(F.struct("metric_type", "metric")).alias("_m"))
            .join(log.select("date", "details"), ["date", "details"], "left_anti")
            .select("_m.metric_type", "details", "_m.metric", "date"))


def metrics_append(log: DataFrame, new: DataFrame) -> DataFrame:
    """K3: the log with the fresh rows of ``new`` (anti-join then union: idempotent on reruns); newest date first."""
    cols = ["metric_type", "details", "metric", "date"]
    return log.select(*cols).unionByName(fresh_metrics(log, new)).orderBy(F.desc("date"), "details")


def metrics_rows(summary: DataFrame, metric_type: str) -> DataFrame:
    """A7 -> K3 rows: ``metric_type, details, metric=1, date`` per summary day."""
    return summary.select(F.lit(metric_type).alias("metric_type"), "details",
                          F.lit(1).cast("long").alias("metric"),
                          F.date_format("day", METRICS_DATE_FORMAT).alias("date"))


def aligned_table(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """K4: per-document side-by-side rows ``(manual, chapter, pos, prev_text, curr_text, status)``.

    Written with ``partitionBy("manual")`` by :func:`palimpsest.sinks.write_aligned`.
    """
    meta = docs.select("doc_id", "manual", "chapter")
    return (pairs.join(meta, "doc_id")
            .select("manual", "chapter", "doc_id", "pos", F.coalesce("prev_text", F.lit("")).alias("prev_text"),
                    F.coalesce("curr_text", F.lit("")).alias("curr_text"), "status"))


def newest_rows(df: DataFrame, ts: str, k: int, part: str | None = None, tie: str | None = None) -> DataFrame:
    """The ``k`` newest rows (per ``part`` when given); ties by ``tie``.

    Per-partition top-k is a window on the partition key. The global form uses
    ``orderBy(...).limit(k)``, which Spark plans as a per-task top-k followed
    by a merge of k rows per task (TakeOrderedAndProject), never a full sort.
    """
    order = [F.desc(ts)] + ([F.asc(tie)] if tie else [])
    if part is None:
        return df.orderBy(*order).limit(k)
    w = Window.partitionBy(part).orderBy(*order)
    return df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)
