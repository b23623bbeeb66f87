"""Snapshot sources: the snapshot-pair fixture (S1/S7 stand-in) and file scans.

A snapshot is a DataFrame ``(doc_id, chapter, manual, title, text)``. In
production the two snapshots are two directories of files (see
:func:`read_snapshot_dir`); in tests both are derived from ``documents`` by the
fixed edit rules below, so the change set is known and grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.sources.tables import read_table

# --- fixed values: the snapshot-pair definition --------------------------
# Previous snapshot: every document except doc_id % 10 = 0 (those are the
# additions). Latest: every document except doc_id % 10 = 1 (the deletions),
# with one edit kind per remaining residue. Shared with the DuckDB oracle.
PREV_SQL = """
SELECT doc_id, concat(upper(lang), CAST(doc_id AS string)) AS chapter,
       source AS manual, text
FROM documents WHERE doc_id % 10 <> 0
"""
LATEST_SQL = """
SELECT doc_id, concat(upper(lang), CAST(doc_id AS string)) AS chapter,
       source AS manual,
       CASE doc_id % 10
         WHEN 2 THEN replace(text, 'e', 'ee')
         WHEN 3 THEN substr(text, instr(text, char(10)) + 1)
         WHEN 4 THEN concat('Inserted opening paragraph.', char(10), text)
         WHEN 5 THEN concat(text, ' ')
         WHEN 6 THEN translate(text, 'a', 'e')
         WHEN 7 THEN concat(text, char(10), 'Appended closing paragraph.')
         ELSE text END AS text
FROM documents WHERE doc_id % 10 <> 1
"""
# --- end of fixed values ---------------------------------------------------


def _with_title(df: DataFrame) -> DataFrame:
    # The heading of a document is its first line.
    return df.withColumn("title", F.substring_index("text", "\n", 1)).select(
        "doc_id", "chapter", "manual", "title", "text")


def snapshot_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Return ``(prev, latest)`` built from ``documents`` (one scan, pruned)."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "lang", "source", "text"])
    return snapshot_pair_from(docs)


def snapshot_pair_from(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Apply the snapshot-pair definition to any ``documents``-shaped frame."""
    spark = docs.sparkSession
    bind = lambda q: q.replace("FROM documents", "FROM {documents}")
    prev = _with_title(spark.sql(bind(PREV_SQL), documents=docs))
    latest = _with_title(spark.sql(bind(LATEST_SQL), documents=docs))
    return prev, latest


def read_snapshot_dir(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """S1 (file form): one row per file with name, size, mtime and whole text.

    ``wholetext`` keeps a document in one row; ``_metadata`` gives the file
    attributes without a second listing pass.
    """
    df = (spark.read.option("wholetext", True).option("pathGlobFilter", glob)
          .option("recursiveFileLookup", True).text(path))
    return df.select(
        F.col("_metadata.file_name").alias("col"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("mtime"),
        F.col("value").alias("text"),
    )


def list_snapshot_dir(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Directory listing as a one-column table ``col`` (plus size, mtime).

    ``binaryFile`` prunes the ``content`` column when it is not selected, so
    this lists files without reading them.
    """
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", True).load(path))
    return df.select(
        F.element_at(F.split("path", "/"), -1).alias("col"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("mtime"),
    )


def snapshot_listing(snapshot: DataFrame) -> DataFrame:
    """S1 over a snapshot table: the file name each document would have."""
    return snapshot.select(F.concat(F.lower("chapter"), F.lit(".xml")).alias("col"))


def save_bucketed_snapshot(snapshot: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Store a snapshot as a table bucketed and sorted on ``doc_id``.

    Written once per day; every later comparison against it (J1-J3, F1, A3,
    the paragraph jobs) joins two tables with the same bucketing, which Spark
    plans without any exchange. Use the same bucket count for every snapshot.
    ``path`` places the table on shared storage (an external table).
    """
    w = snapshot.write.mode("overwrite").bucketBy(buckets, "doc_id").sortBy("doc_id").format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def read_bucketed_snapshot(spark: SparkSession, table: str) -> DataFrame:
    """A stored snapshot; its bucketing is used by joins on ``doc_id``."""
    return spark.table(table).select("doc_id", "chapter", "manual", "title", "text")


def newest_files(spark: SparkSession, path: str, glob: str = "*", k: int = 1) -> DataFrame:
    """The ``k`` most recently modified files matching ``glob``.

    Ties on the modification time are broken by name. The listing never reads
    file contents, and the top-k is a per-task limit followed by a merge.
    """
    listing = list_snapshot_dir(spark, path, glob)
    return listing.orderBy(F.desc("mtime"), F.asc("col")).limit(k)


def newest_logs(spark: SparkSession, path: str, prefix: str, k: int = 2) -> list[str]:
    """Paths of the ``k`` newest log folders ``{prefix}yyyyMMdd`` under ``path``, newest first.

    Newest by the date in the name, then by the newest file inside. Only file
    metadata is listed, and ``k`` paths reach the driver; a read of them scans
    no other folder.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    folder = F.regexp_extract("path", rf"^(.*/{prefix}([0-9]{{8}}))/", 1)
    day = F.regexp_extract("path", rf"^(.*/{prefix}([0-9]{{8}}))/", 2)
    dated = files.select(folder.alias("folder"), day.alias("day"), "modificationTime").where("day <> ''")
    newest = dated.groupBy("folder", "day").agg(F.max("modificationTime").alias("at")).orderBy(F.desc("day"), F.desc("at"), "folder").limit(k)
    return [r["folder"] for r in newest.collect()]
