"""Structured Streaming forms of the daily jobs.

* T1 ingest: crawl reports / feed files arrive in a directory; a file stream
  with an explicit schema turns each into rows.
* T2 one update per key and day: ``dropDuplicatesWithinWatermark``; state is
  bounded by the watermark.
* T3 daily counts: tumbling one-day windows per update type, late rows
  accepted up to the watermark, emitted in append mode.
* T4 metrics sink: ``foreachBatch`` into a table with a commit ledger, so a
  replayed micro-batch writes nothing twice and a half-written one doesn't count.

Checkpoints go to the shared ``spark.checkpoint.dir`` (or a path the caller
names), never to a machine-local folder on a cluster.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.constants import METRICS_DATE_FORMAT
from palimpsest.functions.markup import defect
from palimpsest.session import ensure_checkpoint_dir
from palimpsest.sinks.ledger import LedgerTable
from palimpsest.sources.xml import CRAWL_REPORT_SCHEMA, REPORT_OPTIONS, explode_crawl_report, report_documents


def crawl_report_stream(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """Stream of ``(update_type, id, title, uri)`` rows from report files."""
    raw = (spark.readStream.format("xml").option("rowTag", "report").option("mode", "PERMISSIVE")
           .option("ignoreSurroundingSpaces", False)
           .option("columnNameOfCorruptRecord", "_corrupt_record")
           .option("maxFilesPerTrigger", max_files).schema(CRAWL_REPORT_SCHEMA).load(path))
    return explode_crawl_report(raw)


def report_text_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of crawl reports as text, one a line (``report_xml``), from files in the folder ``path``."""
    raw = spark.readStream.option("recursiveFileLookup", True)
    if max_files:
        raw = raw.option("maxFilesPerTrigger", max_files)
    return raw.text(path).withColumnRenamed("value", "report_xml")


PARSED_REPORT = "kind string, update_type string, id string, title string, uri string, reason string, report_xml string"


def parsed_reports(reports: DataFrame, col: str = "report_xml") -> DataFrame:
    """rows of good reports (``kind`` good) and one row for each that can't be read (``kind`` bad, with its text and the reason).

    A report is parsed once and gives both kinds, so nothing vanishes: the
    reason is the markup's defect, or ``no documents``.
    """
    sound = reports.withColumn("_reason", defect(F.col(col)))
    parsed = sound.withColumn("_r", F.from_xml(F.when(F.col("_reason").isNull(), F.col(col)), CRAWL_REPORT_SCHEMA, REPORT_OPTIONS))
    rows = parsed.withColumn("_rows", report_documents("_r"))
    documents = F.col("_rows")
    reason = F.coalesce("_reason", F.when(F.size(documents) == 0, "no documents"))
    text = lambda n: F.lit(None).cast("string").alias(n)
    bad = F.array(F.struct(F.lit("bad").alias("kind"), *[text(n) for n in ("update_type", "id", "title", "uri")],
                           reason.alias("reason"), F.col(col).alias("report_xml")))
    good = F.transform(documents, lambda d: F.struct(F.lit("good").alias("kind"), *[d[n].alias(n) for n in ("update_type", "id", "title", "uri")],
                                                   text("reason"), text("report_xml")))
    return rows.select(F.inline(F.when(reason.isNotNull(), bad).otherwise(good)))


def report_batch_writer(table: LedgerTable, query: str):
    """``foreachBatch`` function that parses each micro-batch once and keeps good and bad rows, exactly once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if not table.has(batch.sparkSession, query, batch_id):
            table.write(parsed_reports(batch), query, batch_id)
    return write


def event_stream(spark: SparkSession, path: str, schema, max_files: int | None = 1) -> DataFrame:
    """Stream of feed rows (parquet files with an explicit schema); without ``max_files`` all that is there is one batch."""
    raw = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if max_files:
        raw = raw.option("maxFilesPerTrigger", max_files)
    return raw.parquet(path)


def _event_time(stream: DataFrame, ts: str) -> DataFrame:
    """Watermarks need TIMESTAMP; feed files may carry TIMESTAMP_NTZ (read as UTC)."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp"))


def one_per_key_and_day(stream: DataFrame, keys: list[str], ts: str = "ts",
                        delay: str = "1 day") -> DataFrame:
    """Keep the first row per ``keys`` and calendar day within the watermark."""
    return (_event_time(stream, ts).withColumn("day", F.to_date(ts)).withWatermark(ts, delay)
            .dropDuplicatesWithinWatermark(keys + ["day"]))


def daily_counts(stream: DataFrame, kind: str, ts: str = "ts", delay: str = "1 day") -> DataFrame:
    """Rows per ``kind`` per day; each window is emitted once the watermark passes it."""
    return (_event_time(stream, ts).withWatermark(ts, delay)
            .groupBy(F.window(ts, "1 day").alias("w"), kind).agg(F.count(F.lit(1)).alias("n"))
            .select(F.to_date(F.col("w.start")).alias("day"), kind, "n"))


def daily_counts_batch(df: DataFrame, kind: str, ts: str = "ts") -> DataFrame:
    """T3 in batch: the same numbers for the oracle and for back-fills."""
    return df.groupBy(F.to_date(ts).alias("day"), kind).agg(F.count(F.lit(1)).alias("n"))


def metrics_from_counts(counts: DataFrame, kind: str, metric_type: str) -> DataFrame:
    """T4 rows: one metrics-log row per (day, kind) with the count as metric."""
    return counts.select(F.lit(metric_type).alias("metric_type"),
                         F.concat(F.col(kind), F.lit(": "), F.col("n").cast("string")).alias("details"),
                         F.col("n").cast("long").alias("metric"),
                         F.date_format("day", METRICS_DATE_FORMAT).alias("date"))


def checkpoint_location(spark: SparkSession, name: str, base: str | None = None) -> str:
    """A per-query checkpoint folder under the shared checkpoint directory."""
    root = base or ensure_checkpoint_dir(spark)
    return os.path.join(root, "streams", name)


def run_available(query_df: DataFrame, name: str, sink_fn=None, output_mode: str = "append",
                  checkpoint: str | None = None, out: str | None = None):
    """Drive a streaming frame over everything available, then stop.

    With ``sink_fn`` the stream goes to ``foreachBatch(sink_fn)``, with
    ``out`` to Parquet files in that folder, whose log of batches makes each
    count once; otherwise to an in-memory table named ``name`` (tests). Run
    again with the same checkpoint it goes on where it stopped.
    """
    spark = query_df.sparkSession
    ckpt = checkpoint or checkpoint_location(spark, name)
    w = query_df.writeStream.outputMode(output_mode).option("checkpointLocation", ckpt)
    if sink_fn:
        w = w.foreachBatch(sink_fn)
    else:
        w = w.format("parquet").option("path", out) if out else w.format("memory").queryName(name)
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    return q
