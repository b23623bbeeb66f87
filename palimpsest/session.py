"""SparkSession construction and checkpoint-directory handling."""

from __future__ import annotations

import os
import tempfile

from pyspark.errors import PySparkAttributeError
from pyspark.sql import SparkSession

# SQL settings every job relies on; all can be set on a running session, and
# ``configure`` applies them to sessions the engine did not build itself.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast from planner estimates: a side is broadcast either through
    # an explicit size-checked hint (dimension tables) or by AQE after the
    # shuffle stage has been measured below the runtime threshold.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A paragraph table hashed on doc_id can serve joins on (doc_id, pos)
    # and windows on doc_id without a second exchange.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Correctness: with this on, Spark 4.1.2 skipped the exchange of an
    # aggregate over a UNION of two children hashed on the same key through a
    # reused exchange, and EXCEPT ALL returned rows it must not (seen on the
    # remainder check). The union then reports no partitioning and the
    # aggregate shuffles as it should.
    "spark.sql.unionOutputPartitioning": "false",
}
# AQE re-plans joins and coalesces shuffle partitions at runtime; skew-join
# splitting handles a hot key.
DEFAULT_CONF = dict(RUNTIME_CONF, **{
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoint files go when nothing refers to their rows any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
})


def configure(spark: SparkSession) -> None:
    """Apply :data:`RUNTIME_CONF` to a session (e.g. one a driver created)."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def get_session(master: str | None = None, app: str = "palimpsest",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the engine's defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; in tests
    pass ``local[*]`` and a small ``shuffle_partitions``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``palimpsest`` importable in Python workers (UDFs, mapInPandas).

    Zips the package once per application and registers it with
    ``addPyFile``, which distributes it to every executor. Needed whenever the
    driver's own import path is not visible to the workers (cluster, or a
    driver started outside the repository).
    """
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except (AttributeError, PySparkAttributeError):  # Spark Connect: no SparkContext on the client
        sc, app = None, f"connect-{id(spark)}"
    if app in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="palimpsest-pkg-"), "palimpsest.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith((".py", ".csv", ".txt")):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    if sc is not None:
        sc.addPyFile(out)
    else:
        spark.addArtifacts(out, pyfile=True)
    _SHIPPED.add(app)


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint directory named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; we never override it. Only when the
    setting is absent and the master is local (tests) do we set our own, under
    ``fallback`` or a fresh temporary directory; on a cluster that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: a cluster must name a shared folder "
                           "for checkpoints (a machine-local folder does not survive executor loss)")
    path = fallback or tempfile.mkdtemp(prefix="palimpsest-ckpt-")
    os.makedirs(path, exist_ok=True)
    sc.setCheckpointDir(path)
    return path


def cut_lineage(df):
    """Materialise ``df`` to the shared checkpoint directory (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that a job wrote for itself, wherever its file system is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
