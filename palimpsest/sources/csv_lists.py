"""CSV sources (S2): team lists, source-prefix lists, metrics logs.

Schemas are explicit; a UTF-8 byte-order mark on the header is dropped by the
reader; quoted values may contain commas.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.session import ensure_checkpoint_dir

TEAM_DIR = os.path.join(os.path.dirname(os.path.dirname(__file__)), "data", "teams")


def read_list(spark: SparkSession, path: str, column: str = "Source") -> DataFrame:
    """One-column list with a header, values trimmed of nothing (exact match)."""
    return (spark.read.option("header", True).option("escape", '"').option("multiLine", True)
            .option("encoding", "UTF-8").schema(f"`{column}` string").csv(path))


_LANDED: dict[str, str] = {}


def shared_team_lists(spark: SparkSession) -> dict[str, str]:
    """The lists that ship with the package, as files in the shared folder of checkpoints (written once an application).

    The package lies on the driver's disk only; what executors read must not.
    """
    app = spark.sparkContext.applicationId
    if app not in _LANDED:
        folder = f"{ensure_checkpoint_dir(spark)}/teams-{uuid.uuid4().hex}"
        for f in sorted(os.listdir(TEAM_DIR)):
            if f.endswith(".csv"):
                with open(os.path.join(TEAM_DIR, f), encoding="utf-8") as lines:
                    spark.createDataFrame([(lines.read().rstrip("\n"),)], "value string").coalesce(1).write.text(f"{folder}/{f[:-4]}")
        _LANDED[app] = folder
    return {f[:-4]: f"{_LANDED[app]}/{f[:-4]}" for f in sorted(os.listdir(TEAM_DIR)) if f.endswith(".csv")}


def read_team_lists(spark: SparkSession, paths: dict[str, str] | None = None) -> DataFrame:
    """``(team, source)`` from one CSV per team (``Source`` column).

    ``paths`` must sit on shared storage; without them the lists that ship
    with the package serve (:func:`shared_team_lists`).
    """
    out = None
    for team, path in sorted((paths or shared_team_lists(spark)).items()):
        df = read_list(spark, path).select(F.lit(team).alias("team"), F.col("Source").alias("source"))
        out = df if out is None else out.unionByName(df)
    return out


METRICS_SCHEMA = "metric_type string, details string, metric long, date string"


def read_metrics_log(spark: SparkSession, path: str) -> DataFrame:
    """Metrics log ``metric_type, details, metric, date`` (header, explicit schema)."""
    return spark.read.option("header", True).schema(METRICS_SCHEMA).csv(path)
