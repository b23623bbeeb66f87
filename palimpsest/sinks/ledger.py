"""A table written batch by batch, each batch entirely or not at all (T4, K1, K3).

Rows of a batch go to a folder of their own; the batch counts only once an
entry of the ledger names it, and that entry is written last. A batch whose
entry exists is never written again, so a replay is a no-op. A batch that
failed on the way has a folder without an entry: readers don't see it, and the
replay overwrites it. Nothing is renamed or deleted, so any shared file store
will do.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER_SCHEMA = "query string, batch long"


class LedgerTable:
    """``{path}/rows/query=…/batch=…`` and ``{path}/ledger/…``, one folder and one entry a batch of a named query."""

    def __init__(self, path: str, schema: str):
        self.path, self.schema = path, schema

    def _rows(self, query: str, batch: int) -> str:
        return f"{self.path}/rows/query={query}/batch={batch}"

    def committed(self, spark: SparkSession) -> DataFrame:
        """``query, batch`` of all batches that count."""
        try:
            return spark.read.schema(LEDGER_SCHEMA).parquet(f"{self.path}/ledger/*")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], LEDGER_SCHEMA)

    def has(self, spark: SparkSession, query: str, batch: int) -> bool:
        return not self.committed(spark).where((F.col("query") == query) & (F.col("batch") == batch)).isEmpty()

    def newest(self, spark: SparkSession, query: str) -> int | None:
        return self.committed(spark).where(F.col("query") == query).agg(F.max("batch")).first()[0]

    def write_rows(self, rows: DataFrame, query: str, batch: int) -> None:
        """First step: the batch's rows, over whatever a failed attempt left."""
        rows.write.mode("overwrite").parquet(self._rows(query, batch))

    def commit(self, spark: SparkSession, query: str, batch: int) -> None:
        """Second step: from here on the batch counts."""
        spark.createDataFrame([(query, batch)], LEDGER_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/ledger/{query}-{batch}")

    def write(self, rows: DataFrame, query: str, batch: int) -> bool:
        """Write a batch once; False if it counts already."""
        spark = rows.sparkSession
        if self.has(spark, query, batch):
            return False
        self.write_rows(rows, query, batch)
        self.commit(spark, query, batch)
        return True

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows of all batches that count, with ``query`` and ``batch``."""
        try:
            rows = (spark.read.schema(f"{self.schema}, {LEDGER_SCHEMA}").option("basePath", f"{self.path}/rows")
                    .parquet(f"{self.path}/rows"))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], f"{self.schema}, {LEDGER_SCHEMA}")
        return rows.join(self.committed(spark), ["query", "batch"], "left_semi")

    def read_newest(self, spark: SparkSession, query: str) -> DataFrame:
        """The rows of a query's newest batch only: the report as it stands published (K1)."""
        newest = self.newest(spark, query)
        if newest is None:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(self._rows(query, newest))

    def publish(self, rows: DataFrame, query: str) -> int:
        """K1: ``rows`` as the query's next version; readers see the old one until it is complete."""
        version = (self.newest(rows.sparkSession, query) or 0) + 1
        self.write(rows, query, version)
        return version
