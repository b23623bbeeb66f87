"""Document comparison job: list diff -> change test -> per-document metrics ->
significance -> report sections -> per-team reports.

Plan shape: the two snapshots meet once, hash-partitioned on ``doc_id``
(A3's join); additions / deletions are anti-joins of key columns only; team
lists are size-checked broadcasts; the report is one DataFrame written once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.constants import DOWNLOAD_LINK, VIEW_LINK
from palimpsest.functions.text import chapter_link
from palimpsest.operators import relevance, report, scoring, snapshot
from palimpsest.session import cut_lineage


def document_info(rows: DataFrame) -> DataFrame:
    """Source, chapter, title and link of listed documents (additions or deletions, as J2 and J1 return them)."""
    return rows.select("doc_id", F.col("manual").alias("source"), F.col("chapter").alias("chapter_number"),
                       "title", chapter_link("chapter", ".html", VIEW_LINK).alias("link"))


def listed(additions: DataFrame, deletions: DataFrame) -> DataFrame:
    """P7 + P3 + O1: both lists as published: ``section, section_rank, source, chapter_number, title, html, tracked_changes``.

    Ranked by chapter, last first, within each list.
    """
    def table(rows: DataFrame, section: str) -> DataFrame:
        view = chapter_link("chapter", ".html", VIEW_LINK)
        return rows.select(F.lit(section).alias("section"), F.col("manual").alias("source"), F.col("chapter").alias("chapter_number"), "title",
                           F.replace(F.replace(view, F.lit("—"), F.lit(" ")), F.lit("’"), F.lit("'")).alias("html"),
                           chapter_link("chapter", ".docx", DOWNLOAD_LINK).alias("tracked_changes"))
    both = table(additions, "additions").unionByName(table(deletions, "deletions"))
    return report.ranked(cut_lineage(both), F.asc("section"), F.desc("chapter_number"), F.asc("source"), within="section")


def change_table(metrics: DataFrame) -> DataFrame:
    """F2 -> P4 -> P3 -> P2: the published change list (sorted by distance)."""
    sig = scoring.significant_changes(metrics)
    info = report.change_info(sig)
    out = info.select(
        "doc_id", "source", "chapter_number", "title",
        F.col("lev_distance").cast("int").alias("lev_distance"),
        F.col("change_info"), F.replace(F.replace("html", F.lit("—"), F.lit(" ")), F.lit("’"), F.lit("'")).alias("html"),
        chapter_link("chapter_number", "-comp.docx", DOWNLOAD_LINK).alias("tracked_changes"))
    return out


def sections_of(prev: DataFrame, latest: DataFrame) -> DataFrame:
    """K2 by one full outer join: the section follows from the side that is missing.

    Each snapshot is read and exchanged once. Only documents that changed
    carry their texts to the distance; the others carry empty ones.
    """
    side = lambda df, p: df.select("doc_id", *[F.col(c).alias(f"{p}_{c}") for c in ("chapter", "manual", "title", "text")])
    section = (F.when(F.col("prev_text").isNull(), "additions").when(F.col("curr_text").isNull(), "deletions")
               .when(F.col("prev_text") != F.col("curr_text"), "changes"))
    j = side(prev, "prev").join(side(latest, "curr"), "doc_id", "full_outer").withColumn("section", section).where("section IS NOT NULL")
    text = lambda c: F.when(F.col("section") == "changes", F.col(c)).otherwise(F.lit(""))
    rows = j.select("doc_id", "section", *[F.when(F.col("section") == "additions", F.col(f"curr_{c}")).otherwise(F.col(f"prev_{c}")).alias(n)
                                           for c, n in (("chapter", "chapter"), ("manual", "manual"), ("title", "prev_title"))],
                    text("prev_text").alias("prev_text"), text("curr_text").alias("curr_text"))
    scored = report.change_info(scoring.pair_metrics(rows, ("section",)))
    changed = F.col("section") == "changes"
    return (scored.where(~changed | scoring.significant("lev_distance", "para_change_count"))
            .select("section", "source", "chapter_number", "title", F.when(changed, F.col("change_info")).alias("info"),
                    F.when(changed, F.col("lev_distance")).alias("sort_key")))


def build(prev: DataFrame, latest: DataFrame, teams: DataFrame | None = None,
          metrics: DataFrame | None = None) -> dict[str, DataFrame]:
    """All outputs of the job, lazily defined (``metrics`` may be precomputed)."""
    joined = metrics is None
    if joined:
        metrics = scoring.document_metrics(prev, latest)
    adds = snapshot.additions(prev, latest)
    dels = snapshot.deletions(prev, latest)
    sections = (sections_of(prev, latest) if joined
                else report.report_sections(scoring.significant_changes(metrics), adds, dels))
    out = {"metrics": metrics, "changes": change_table(metrics), "additions": adds, "deletions": dels,
           "report": sections, "counts": report.section_counts(sections)}
    if teams is not None:
        by_team = relevance.team_rows(sections, teams)
        out["team_report"] = by_team
        out["team_counts"] = report.section_counts(sections, by_team)
    return out


def run(prev: DataFrame, latest: DataFrame, out_dir: str, teams: DataFrame | None = None) -> None:
    """Write the change list, the report and (with teams) one report folder per team.

    The metrics feed every output; they are materialised once in the shared
    checkpoint directory, so the distances are not recomputed per output and
    a lost executor does not send the job back to the snapshots.
    """
    from palimpsest.sinks import write_csv

    metrics = cut_lineage(scoring.document_metrics(prev, latest))
    outputs = build(prev, latest, teams, metrics=metrics)
    write_csv(outputs["changes"].orderBy(F.desc("lev_distance"), "chapter_number"), f"{out_dir}/changes")
    write_csv(report.ordered_report(outputs["report"]), f"{out_dir}/report")
    write_csv(outputs["counts"], f"{out_dir}/counts")
    if "team_report" in outputs:
        write_csv(outputs["team_report"], f"{out_dir}/teams", partition_by=["team"])
