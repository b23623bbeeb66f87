"""End-to-end jobs and sinks: K1 CSV, K4 partitioned table, document job run."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from palimpsest.operators import paragraphs, report
from palimpsest.plans import document_changes
from palimpsest.sinks import write_aligned, write_csv
from palimpsest.sources.csv_lists import read_team_lists
from palimpsest.sources.snapshots import snapshot_pair


def test_csv_sink_roundtrip(spark, workdir):
    df = spark.createDataFrame([(1, "a,b"), (2, 'say "x"')], "id long, v string")
    out = os.path.join(workdir, "k1")
    write_csv(df, out)
    back = spark.read.option("header", True).option("escape", '"').schema("id long, v string").csv(out)
    assert sorted(tuple(r) for r in back.collect()) == [(1, "a,b"), (2, 'say "x"')]
    write_csv(df.limit(1), out)                       # overwrite, not append
    assert spark.read.option("header", True).csv(out).count() == 1


def test_aligned_table_partitioned(spark, workdir):
    prev, latest = snapshot_pair(spark, SF_SMALL)
    pairs = paragraphs.pair_paragraphs(paragraphs.explode_paragraphs(prev), paragraphs.explode_paragraphs(latest))
    aligned = report.aligned_table(pairs, prev)
    out = os.path.join(workdir, "k4")
    write_aligned(aligned, out)
    manuals = {d for d in os.listdir(out) if d.startswith("manual=")}
    assert manuals == {f"manual={r.manual}" for r in prev.select("manual").distinct().collect()}
    assert spark.read.parquet(out).count() == aligned.count()


def test_document_job_run(spark, workdir):
    prev, latest = snapshot_pair(spark, SF_SMALL)
    out = os.path.join(workdir, "job")
    document_changes.run(prev, latest, out, read_team_lists(spark))
    rep = spark.read.option("header", True).csv(f"{out}/report")
    counts = {r.section: int(r.n) for r in spark.read.option("header", True).csv(f"{out}/counts").collect()}
    assert counts["ALL"] == rep.count()
    assert counts["additions"] == 20 and counts["deletions"] == 20
    teams = {d for d in os.listdir(f"{out}/teams") if d.startswith("team=")}
    assert teams <= {"team=alpha", "team=beta", "team=gamma"} and teams
    ch = spark.read.option("header", True).csv(f"{out}/changes")
    assert ch.where(F.col("lev_distance").cast("int") <= 50).count() == 0


def test_bucketed_snapshots_join_without_exchange(spark, workdir):
    from palimpsest.operators import scoring
    from palimpsest.sources.snapshots import read_bucketed_snapshot, save_bucketed_snapshot
    prev, latest = snapshot_pair(spark, SF_SMALL)
    save_bucketed_snapshot(prev, "snap_prev", 4, os.path.join(workdir, "snap_prev"))
    save_bucketed_snapshot(latest, "snap_latest", 4, os.path.join(workdir, "snap_latest"))
    p, l = read_bucketed_snapshot(spark, "snap_prev"), read_bucketed_snapshot(spark, "snap_latest")
    metrics = scoring.document_metrics(p, l)
    plan = metrics._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert metrics.count() == scoring.document_metrics(prev, latest).count()


def test_crawl_report_job(spark):
    from palimpsest.plans.catalog import REGISTRY, _status, RUN_DATE
    from palimpsest.plans.daily_jobs import crawl_report_job
    from palimpsest.sources import xml
    prev, latest = snapshot_pair(spark, SF_SMALL)
    st = _status(spark, SF_SMALL).where(F.col("update_type") != "same")
    rows = xml.explode_crawl_report(xml.parse_crawl_report_column(xml.document_report_xml(st)))
    page = lambda df: df.select(
        F.concat(F.lit("https://manuals.example.org/"), F.col("manual"), F.lit("/"), F.lower("chapter")).alias("uri"),
        "text")
    out = crawl_report_job(rows, page(latest), page(prev), RUN_DATE)
    adds = out["additions"].collect()
    assert len(adds) == 20 and all(r.chapter == r.chapter.upper() and r.manual[0].isupper() for r in adds)
    changes = out["changes"].collect()
    n_changed = st.where("update_type = 'change'").count()
    assert len(changes) == n_changed
    assert all(r.redline is not None for r in changes)
    # a trailing blank (edit kind 5) is trimmed before pairing: nothing to mark
    marked = [r for r in changes if int(r.id) % 10 != 5]
    assert marked and all("<del>" in r.redline or "<ins>" in r.redline for r in marked)
    assert all("<del>" not in r.redline for r in changes if int(r.id) % 10 == 5)
    m = out["metrics"].collect()
    assert len(m) == 1 and m[0].details == f"Additions: 20, Changes: {n_changed}, Deletions: 20"
    assert m[0].date == RUN_DATE


def test_updates_feed_job(spark):
    from palimpsest.functions.html import article_body, strip_navigation, url_part
    from palimpsest.plans.daily_jobs import updates_feed_job
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("url", "html")
    feed_rows = (pages.select(F.to_timestamp(F.lit("2024-01-15 10:00:00")).alias("ts"), "url",
                              F.lit("t").alias("title"))
                 .unionByName(spark.createDataFrame([("2024-01-14 09:00:00", "https://x.example.com/en/1", "old")],
                                                    "ts string, url string, title string")
                              .select(F.to_timestamp("ts").alias("ts"), "url", "title")))
    bodies = pages.select(url_part("url", 1).alias("manual"), url_part("url", 2).alias("chapter"),
                          article_body(strip_navigation(F.col("html"))).alias("body"))
    # yesterday's archive: a few chapters, first paragraph of each body rewritten
    archive = (bodies.dropDuplicates(["chapter"]).orderBy("chapter").limit(5)
               .unionByName(bodies.select(F.lit("another manual").alias("manual"), "chapter", "body"))
               .withColumn("body", F.regexp_replace("body", r"(?s)^(.*?)<p>", "<p>Yesterday's opening.</p>$1<p>"))
               .withColumn("version_key", F.concat("chapter", F.lit("-20240114"))))
    out = updates_feed_job(feed_rows, pages, archive, "2024-01-15", marker=".example.")
    n_pages = pages.count()
    assert out["updates"].count() == n_pages                       # the older row is not read
    archived = {r.chapter for r in archive.where("manual <> 'another manual'").collect()}
    changes = out["changes"].collect()
    assert {r.chapter for r in changes} == archived
    assert all(r.redline and ("<del>" in r.redline or "<ins>" in r.redline) for r in changes)
    assert out["new"].count() + out["deletions"].count() + len(changes) == n_pages
    m = out["metrics"].collect()
    assert [r.details for r in m] == [f"Updates: {n_pages}"]
    record = out["updates"].collect()
    assert all(r.above_threshold for r in record if r.update_type != "change") and {r.title for r in record} == {"t"}
    assert out["dead"].count() == 0


def test_newest_versions(spark):
    from palimpsest.plans.daily_jobs import newest_versions
    rows = [("m", "c1", "c1-20240110", "old"), ("m", "c1", "c1-20240113", "new"), ("m", "c1", "c1-20240113", "newer"),
            ("m", "c1", "c1-20240115", "of the day"), ("m", "c2", "c2-20240116", "later"), ("m", "c3", "c3", "no date"),
            ("m", "c4", None, "no key"), ("n", "c1", "c1-20231231", None)]
    got = newest_versions(spark.createDataFrame(rows, "manual string, chapter string, version_key string, body string"), "2024-01-15").collect()
    assert sorted((r.manual, r.chapter, r.prev_body, str(r.prev_version)) for r in got) == [
        ("m", "c1", "newer", "2024-01-13"), ("n", "c1", None, "2023-12-31")]


def test_report_of_day_gates(spark):
    from palimpsest.plans.daily_jobs import report_of_day
    rows = spark.sql("SELECT date'2024-01-14' AS report_date, 1 AS x UNION ALL SELECT date'2024-01-15', 2")
    assert [r.x for r in report_of_day(rows, "2024-01-15").collect()] == [2]
    assert report_of_day(rows, "2024-01-16").count() == 0 and report_of_day(rows, "2024-01-14").count() == 0


def test_global_rank(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") % 3).cast("string").alias("g"), (F.hash("id") % 50).alias("v"), "id")
    got = report.ranked(df, F.asc("g"), F.desc("v"), F.asc("id"), within="g").collect()
    want = sorted(got, key=lambda r: (r.g, -r.v, r.id))
    assert [r["rank"] for r in want] == list(range(1, 5001))
    seen = {}
    for r in want:
        seen[r.g] = seen.get(r.g, 0) + 1
        assert r.g_rank == seen[r.g]
    assert report.ranked(df.where("id < 0"), F.asc("id")).count() == 0


def test_rank_has_one_range_exchange_and_no_single_task(spark):
    import re
    df = spark.range(1000).select((F.col("id") % 10).alias("v"), "id")
    plans = []
    real = report.cut_lineage

    def seen(x):
        plans.append(x._jdf.queryExecution().executedPlan().toString())
        return real(x)
    report.cut_lineage = seen
    try:
        out = report.ranked(df, F.asc("v"), F.asc("id"))
    finally:
        report.cut_lineage = real
    assert len(re.findall(r"Exchange rangepartitioning", plans[0])) == 1 and "SinglePartition" not in plans[0]
    # afterwards only the counts of ranges, one row each, meet in one place
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Exchange hashpartitioning(v" not in plan
    assert out.agg(F.max("rank")).first()[0] == 1000


def test_ranked_changes_take_the_distances_once(spark):
    df = spark.createDataFrame([(i, f"C{i}", i % 7) for i in range(50)], "doc_id long, chapter_number string, lev_distance long")
    plans, real = [], report.cut_lineage

    def seen(x):
        plans.append(x._jdf.queryExecution().executedPlan().toString())
        return real(x)
    report.cut_lineage = seen
    try:
        out = report.ranked_changes(df.withColumn("lev_distance", F.col("lev_distance") + F.floor(F.rand(1))))
    finally:
        report.cut_lineage = real
    assert "rand(" in plans[0] and "rangepartitioning" not in plans[0]  # what the range exchange samples is made before it
    assert "rand(" not in plans[1] and "rangepartitioning" in plans[1]
    assert out.count() == 50


def test_chapter_list_is_ranked(spark):
    from palimpsest.plans.paragraph_changes import chapter_list
    rows = [(1, "B1", "Previous title", "L1, L2", 3), (2, "A1", "t", "", 3), (3, "C1", "u", "", 9)]
    got = chapter_list(spark.createDataFrame(rows, "doc_id long, chapter string, title string, doc_info string, n_paras_with_changes long"))
    assert [tuple(r) for r in got.orderBy("rank").collect()] == [
        (1, "C1", "u", "", 9, "Click to view"), (2, "A1", "t", "", 3, "Click to view"), (3, "B1", " title", "L1, L2", 3, "Click to view")]


def test_term_records_defaults(spark):
    from palimpsest.plans.term_locations import records
    members = spark.createDataFrame([(1, "g/EN_ch_1.xml", "<d><kh:document-title>A &amp; B</kh:document-title><b>red <i>and</i> blue red</b></d>"),
                                     (2, "g/odd.xml", "<d>red"), (3, "h/EN_ch_3.xml", "<d>red</d>"), (4, "g/EN_ch_4.txt", "red")],
                                    "doc_id long, member string, xml string")
    groups = spark.createDataFrame([("g",)], "grp string")
    terms = spark.createDataFrame([(1, "red"), (2, "red and")], "term_idx long, term string")
    got = sorted(tuple(r) for r in records(members, groups, terms).collect())
    assert got == [("1", "A & B", "EN", "EN_ch_1.xml", "red", 2), ("1", "A & B", "EN", "EN_ch_1.xml", "red and", 3),
                   ("not found", "not found", "not found", "odd.xml", "red", 1)]
