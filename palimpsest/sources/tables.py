"""Parquet table scans (S7 and every test table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    """Scan one table; naming ``columns`` keeps the parquet ReadSchema narrow."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def read_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched pages arrive as a table ``(page_id, url, html)``."""
    return read_table(spark, sf_dir, "pages", ["page_id", "url", "html"])
