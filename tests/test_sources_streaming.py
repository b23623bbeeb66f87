"""Sources (CSV lists, XML documents, crawl reports, directory scans) and the
streaming jobs T1–T4 driven with ``availableNow`` over split files."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from palimpsest.sinks import METRICS, metrics_batch_writer
from palimpsest.sinks.ledger import LedgerTable
from palimpsest.sources import csv_lists, xml
from palimpsest.sources.snapshots import list_snapshot_dir, read_snapshot_dir, snapshot_pair
from palimpsest.streaming import change_feed


def test_team_lists_bom_quotes_case(spark):
    teams = csv_lists.read_team_lists(spark)
    rows = {(r.team, r.source) for r in teams.collect()}
    assert ("beta", "src0") in rows          # BOM header read as `Source`
    assert ("alpha", "src7") in rows         # quoted value
    assert ("alpha", "SRC2") in rows         # case kept: never equals src2
    assert teams.where(F.col("source").isNull()).count() == 0


def test_team_list_commas(spark, workdir):
    p = os.path.join(workdir, "t.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write('﻿Source\n"North, South and East"\nWest region\n')
    got = [r.Source for r in csv_lists.read_list(spark, p).collect()]
    assert got == ["North, South and East", "West region"]


REPORT = """<report>
  <added><document id="1" title="T1" uri="https://m.example.org/a/ch1"/></added>
  <changed><document id="2" title=" Two " uri="https://m.example.org/a/ch2"/>
           <document id="3" title="T3" uri="https://m.example.org/b/ch3"/></changed>
  <removed/>
</report>"""


def test_crawl_report_files(spark, workdir):
    d = os.path.join(workdir, "reports")
    os.makedirs(d)
    with open(os.path.join(d, "r1.xml"), "w") as f:
        f.write(REPORT)
    with open(os.path.join(d, "bad.xml"), "w") as f:
        f.write("<report><added><document id='9'</report>")
    reports = xml.read_crawl_reports(spark, d)
    good, bad = xml.split_bad_records(reports)
    assert len(bad.collect()) >= 1
    rows = sorted((r.update_type, r.id, r.title) for r in xml.explode_crawl_report(good).collect())
    assert rows == [("change", "2", " Two "), ("change", "3", "T3"), ("new", "1", "T1")]


def test_xml_documents_roundtrip(spark, workdir):
    prev, _ = snapshot_pair(spark, SF_SMALL)
    src = prev.limit(5)
    out = os.path.join(workdir, "xmldocs")
    xml.documents_to_xml(src).select("xml").write.text(out)
    # files written by Spark's text sink hold one document per line
    parsed = xml.parse_xml_documents(spark.read.text(out).select(F.col("value").alias("xml")))
    got = {(r.chapter, r.manual) for r in parsed.collect()}
    assert got == {(r.chapter, r.manual) for r in src.collect()}


def test_directory_listing(spark, workdir):
    d = os.path.join(workdir, "snap")
    os.makedirs(d)
    for i in range(3):
        with open(os.path.join(d, f"ch{i}.xml"), "w") as f:
            f.write("x" * (i + 1))
    listing = list_snapshot_dir(spark, d, "*.xml").orderBy("col").collect()
    assert [(r.col, r.size) for r in listing] == [("ch0.xml", 1), ("ch1.xml", 2), ("ch2.xml", 3)]
    docs = read_snapshot_dir(spark, d, "*.xml").orderBy("col").collect()
    assert [r.text for r in docs] == ["x", "xx", "xxx"]


def _split_events(spark, workdir, parts=4):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    d = os.path.join(workdir, "events_in")
    for i in range(parts):
        # chronological files: each one holds a later block of days
        block = (F.dayofmonth("ts") - 1) * parts / 31
        ev.where(F.floor(block) == i).coalesce(1).write.parquet(os.path.join(d, f"part{i}"))
    return ev, d


def test_streaming_daily_counts_match_batch(spark, workdir):
    ev, d = _split_events(spark, workdir)
    stream = change_feed.event_stream(spark, d, ev.schema, max_files=1)
    q = change_feed.run_available(change_feed.daily_counts(stream, "event_type", delay="0 seconds"),
                                  "daily_counts_t3", checkpoint=os.path.join(workdir, "ck3"))
    assert q.exception() is None
    got = {(r.day, r.event_type, r.n) for r in spark.table("daily_counts_t3").collect()}
    want = {(r.day, r.event_type, r.n) for r in change_feed.daily_counts_batch(ev, "event_type").collect()}
    # windows still open at the end of the stream are not emitted in append mode
    assert got <= want and len(got) >= len(want) - 5


def test_streaming_dedup_and_metrics_sink(spark, workdir):
    ev, d = _split_events(spark, workdir)
    stream = spark.readStream.schema(ev.schema).option("recursiveFileLookup", True).parquet(d)
    dedup = change_feed.one_per_key_and_day(stream, ["user_id", "event_type"])
    change_feed.run_available(dedup, "dedup_t2", checkpoint=os.path.join(workdir, "ck2"))
    n = spark.table("dedup_t2").count()
    want = ev.select("user_id", "event_type", F.to_date("ts")).distinct().count()
    assert n == want

    table = LedgerTable(os.path.join(workdir, "metrics"), METRICS)
    sink = metrics_batch_writer(table, "daily")
    rows = change_feed.metrics_from_counts(
        change_feed.daily_counts_batch(ev, "event_type"), "event_type", "daily count")
    assert table.read(spark).count() == 0
    sink(rows, 0)
    sink(rows, 0)                      # replayed batch: nothing new is written
    sink(rows, 1)                      # the same rows in another batch are logged already
    assert table.read(spark).count() == rows.count()
    assert {(r["query"], r["batch"]) for r in table.committed(spark).collect()} == {("daily", 0), ("daily", 1)}


def test_half_written_batch_does_not_count(spark, workdir):
    table = LedgerTable(os.path.join(workdir, "half"), "v string")
    rows = lambda *v: spark.createDataFrame([(x,) for x in v], "v string")
    assert table.write(rows("a"), "q", 0)
    table.write_rows(rows("lost", "lost too"), "q", 1)          # the job died before the commit
    assert [r.v for r in table.read(spark).collect()] == ["a"]
    assert table.write(rows("b"), "q", 1) and not table.write(rows("c"), "q", 1)
    assert sorted(r.v for r in table.read(spark).collect()) == ["a", "b"]


def test_failed_publish_leaves_the_old_report(spark, workdir):
    table = LedgerTable(os.path.join(workdir, "published"), "v string")
    assert table.read_newest(spark, "report").count() == 0
    assert table.publish(spark.createDataFrame([("old",)], "v string"), "report") == 1
    broken = spark.range(3).select(F.when(F.col("id") < 2, "new").otherwise(F.raise_error(F.lit("lost"))).cast("string").alias("v"))
    with pytest.raises(Exception, match="lost"):
        table.publish(broken, "report")
    assert [r.v for r in table.read_newest(spark, "report").collect()] == ["old"]
    assert table.publish(spark.createDataFrame([("new",)], "v string"), "report") == 2
    assert [r.v for r in table.read_newest(spark, "report").collect()] == ["new"]


def test_parsed_reports_keep_bad_ones(spark):
    texts = [REPORT, "<report><added>", "<report/>", None, "", "<report>a & b</report>", REPORT + REPORT]
    got = change_feed.parsed_reports(spark.createDataFrame([(t,) for t in texts], "report_xml string")).collect()
    assert sum(r.kind == "good" for r in got) == 3
    assert sorted(r.reason for r in got if r.kind == "bad") == sorted(
        ["unbalanced tags", "no documents", "empty", "empty", "bare ampersand", "several roots"])


def test_newest_logs_prune_the_scan(spark, workdir):
    from palimpsest.sources.snapshots import newest_logs
    for day in ("20240103", "20240101", "20240105", "20240102", "20240104"):
        spark.createDataFrame([(day,)], "d string").write.parquet(os.path.join(workdir, f"log-{day}"))
    paths = newest_logs(spark, workdir, "log-", 2)
    assert [p[-8:] for p in paths] == ["20240105", "20240104"]
    scanned = spark.read.parquet(*paths).inputFiles()
    assert scanned and all("20240105" in f or "20240104" in f for f in scanned)


def test_crawl_report_stream(spark, workdir):
    d = os.path.join(workdir, "report_stream")
    os.makedirs(d)
    for i in range(2):
        with open(os.path.join(d, f"r{i}.xml"), "w") as f:
            f.write(REPORT)
    q = change_feed.run_available(change_feed.crawl_report_stream(spark, d), "crawl_t1",
                                  checkpoint=os.path.join(workdir, "ck1"))
    assert q.exception() is None
    assert spark.table("crawl_t1").count() == 6


def test_newest_files(spark, workdir):
    import time as _t
    from palimpsest.sources.snapshots import newest_files
    d = os.path.join(workdir, "logs")
    os.makedirs(d)
    for i, name in enumerate(["log-a.csv", "log-b.csv", "log-c.csv", "other.txt"]):
        p = os.path.join(d, name)
        with open(p, "w") as f:
            f.write("x")
        os.utime(p, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    got = [r.col for r in newest_files(spark, d, "log-*.csv", 2).collect()]
    assert got == ["log-c.csv", "log-b.csv"]


def test_archive_dump_from_files(spark, workdir):
    from palimpsest.operators import search
    root = os.path.join(workdir, "dump")
    members = {"grpA/EN_ch_1.xml": "alpha beta", "grpA/EN_ch_2.xml": "beta", "grpB/FR_ch_3.xml": "beta beta"}
    for rel, text in members.items():
        os.makedirs(os.path.dirname(os.path.join(root, rel)), exist_ok=True)
        with open(os.path.join(root, rel), "w") as f:
            f.write(text)
    arch = search.read_archive(spark, root)
    parsed = arch.select("member", "text", *search.parse_member_path("member"))
    groups = spark.createDataFrame([("grpA",)], "grp string")
    kept = search.members_in_groups(parsed, groups)
    got = sorted((r.grp, r.filename, r.doc_ref, r.area) for r in kept.collect())
    assert got == [("grpA", "EN_ch_1.xml", "1", "EN"), ("grpA", "EN_ch_2.xml", "2", "EN")]
    docs = kept.select(F.col("doc_ref").cast("long").alias("doc_id"), "text")
    terms = spark.createDataFrame([(1, "beta")], "term_idx long, term string")
    hits = {(r.doc_id, r.n_hits) for r in search.term_hits(docs, terms).collect()}
    assert hits == {(1, 1), (2, 1)}


def test_xml_documents_from_files(spark, workdir):
    prev, _ = snapshot_pair(spark, SF_SMALL)
    src = prev.limit(3).collect()
    d = os.path.join(workdir, "chapters")
    os.makedirs(d)
    rendered = xml.documents_to_xml(spark.createDataFrame(src)).collect()
    for r in rendered:
        with open(os.path.join(d, f"ch{r.doc_id}.xml"), "w", encoding="utf-8") as f:
            f.write(r.xml)
    with open(os.path.join(d, "notes.txt"), "w") as f:
        f.write("not a chapter")
    parsed = xml.read_xml_documents(spark, d).collect()
    assert sorted((p.chapter, p.manual) for p in parsed) == sorted((s.chapter, s.manual) for s in src)
    by_chapter = {s.chapter: s for s in src}
    for p in parsed:
        want = [x for x in by_chapter[p.chapter].text.split("\n") if x != ""]
        assert [x for x in p.text.split("\n") if x != ""] == want
        assert p.title == by_chapter[p.chapter].title
