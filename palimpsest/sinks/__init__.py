"""Sinks: CSV report tables (K1), aligned per-document tables (K4), metrics log (K3).

Each writes once per job. Tables that are written batch by batch, and reports
that replace each other, go through :class:`palimpsest.sinks.ledger.LedgerTable`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.operators.report import fresh_metrics
from palimpsest.sinks.ledger import LedgerTable


def write_csv(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """K1: header, no index, overwrite; RFC 4180 quoting (quotes doubled)."""
    w = df.write.mode("overwrite").option("header", True).option("escape", '"')
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_aligned(aligned: DataFrame, path: str) -> None:
    """K4: one directory per manual; a document's rows stay together and in order.

    Hashing on ``(manual, doc_id)`` rather than ``manual`` alone spreads a
    manual that holds a large share of the corpus over many writer tasks.
    """
    (aligned.repartition("manual", "doc_id").sortWithinPartitions("manual", "chapter", "pos")
     .write.mode("overwrite").partitionBy("manual").parquet(path))


def append_metrics(log: DataFrame, new: DataFrame, path: str) -> DataFrame:
    """K3: append only the rows that are not yet logged (idempotent on reruns).

    Returns the rows written. ``log`` is the current content of ``path``.
    """
    fresh = fresh_metrics(log, new)
    fresh.write.mode("append").option("header", True).csv(path)
    return fresh


METRICS = "metric_type string, details string, metric long, date string"


def metrics_batch_writer(table: LedgerTable, query: str):
    """T4: ``foreachBatch`` function that logs each micro-batch's fresh metrics exactly once.

    ``table`` has the columns of ``METRICS``. A batch that the ledger names is
    skipped; one that failed half-way is written anew (see
    :mod:`palimpsest.sinks.ledger`). Rows that an earlier batch or query
    logged for the same date and details are not logged again (K3).
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not table.has(spark, query, batch_id):
            rows = batch.select("metric_type", "details", F.col("metric").cast("long"), "date")
            table.write(fresh_metrics(table.read(spark), rows), query, batch_id)
    return write
