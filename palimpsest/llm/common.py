"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.session import cut_lineage, ship_package

WORD = r"[^\x20\x09-\x0D]+"
BATCH = 4 << 20  # bytes of an Arrow batch to a Python worker, about (one row at least)
EDGES_A_TASK = 50_000  # edges that one task of a round of connected components gets at least


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_workers(spark: SparkSession) -> SparkSession:
    """Make the package importable in Python workers, which get their rows in Arrow batches of about ``BATCH`` bytes.

    Spark's own bound is 64 MB, held several times over (JVM, pipe, worker) by every chained step of every task.
    """
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))
    return spark


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[SparkSession]:
    """Shuffle files go at the end of each job run inside, not when the driver happens to collect its garbage (from Spark 4.1 on).

    For steps that each end in ``cut_lineage``: what they shuffled is not read again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield spark
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it (letter case aside)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z only; other letters stay."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def is_held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 5 is 0 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def partitions_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranged(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` in ranges of ``order``, one per partition, with the range's number in ``_part``.

    The rows are checkpointed, so that the numbers hold however often the
    result is read: a range exchange samples anew each time it runs.
    """
    n = partitions_of(df.sparkSession)
    return cut_lineage(df.repartitionByRange(n, *order)).withColumn("_part", F.spark_partition_id())


def min_labels(spark: SparkSession, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components: ``(node, label)`` with the smallest node reachable, for nodes in ``edges``.

    ``edges`` has columns ``a`` and ``b`` (equal types, no nulls). Alternates
    large-star and small-star steps (Kiveris et al. 2014) until the edges form
    stars, which takes O(log^2 n) rounds; each round aggregates by key with
    map-side partial sums and is checkpointed. A node with very many
    neighbours is never gathered: a step needs each node's minimum only.
    """
    e = cut_lineage(edges.select("a", "b").where("a <> b").distinct())

    def parts(rows: int) -> int:
        # small edge lists go on in few partitions: a round has several shuffles, each with files for each of them
        return min(partitions_of(spark), 1 + rows // EDGES_A_TASK)

    def star(e: DataFrame, large: bool, n: int) -> DataFrame:
        if large:
            both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
            low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
            out = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            low = down.groupBy("a").agg(F.min("b").alias("m"))
            out = (down.join(low, "a").select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("x"))
                   .select(F.col("x.b").alias("a"), F.col("x.m").alias("b")))
        return out.where("a <> b").coalesce(n).distinct().coalesce(n)

    def state(e: DataFrame) -> tuple:
        r = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    last = state(e)
    for _ in range(max_rounds):
        if not last[0]:
            break
        n = parts(last[0])
        e = cut_lineage(star(star(e.coalesce(n), True, n), False, n))
        now = state(e)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("connected components did not settle")
    down = e.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("label"))
    roots = down.select("label").distinct().select(F.col("label").alias("node"), "label")
    return down.union(roots)


def give_back() -> None:
    """Hand memory that this worker no longer uses back to the system, where the C library can do that.

    Workers wait for further tasks, of other stages too, with what they have
    allocated; several of them share an executor's memory.
    """
    import ctypes
    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slices(batches: Iterator, text: int, max_bytes: int = 1 << 20) -> Iterator:
    """Arrow batches cut into runs of rows whose text column holds about ``max_bytes`` (one row at least).

    numpy needs some 30 to 60 times as much for hashes of bytes and words; at
    the end of the task it goes back to the system.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        lo = 0
        while lo < batch.num_rows:
            base = size[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(size, base + max_bytes, side="right")))
            yield pa.RecordBatch.from_arrays([c.slice(lo, hi - lo) for c in batch.columns], schema=batch.schema)
            lo = hi
    give_back()


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


class Sieve:
    """A bitmap of hashed values: tells which rows cannot be in a set, before they are shuffled to it.

    It has 16 bits for each value, 2^28 (32 MB) at most whatever the size of
    the set; beyond that it lets more rows through, and the exact join that
    follows stays the judge. Made by Spark's bitmap aggregates; only the
    finished bits reach the driver.
    """

    MOST_BITS = 1 << 28

    def __init__(self, df: DataFrame, hash_col: Column):
        import numpy as np
        values = df.select(hash_col.alias("h"))
        self.bits = min(self.MOST_BITS, max(1 << 15, 1 << (16 * values.count()).bit_length()))
        at = F.pmod(F.col("h"), F.lit(self.bits)) + 1
        rows = (values.groupBy(F.bitmap_bucket_number(at).alias("bucket"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect())
        whole = np.zeros(self.bits // 8, np.uint8)
        for r in rows:
            whole[(r["bucket"] - 1) * 4096:r["bucket"] * 4096] = np.frombuffer(r["bits"], np.uint8)
        self.shared = df.sparkSession.sparkContext.broadcast(whole)

    def __getstate__(self):
        return self.bits, self.shared

    def __setstate__(self, state):
        self.bits, self.shared = state

    def may_hold(self, h):
        """For an int64 array of hashes: False where the value is certainly not in the set."""
        import numpy as np
        at = np.mod(h, self.bits)
        return (self.shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)

    def rows(self, df: DataFrame, hash_name: str, keep: bool = True) -> DataFrame:
        """The rows of ``df`` whose hash may be in the set (or, with ``keep`` False, the others)."""
        import pyarrow as pa
        at, sieve = df.columns.index(hash_name), self

        def run(batches: Iterator) -> Iterator:
            for b in batches:
                yield b.filter(pa.array(sieve.may_hold(b.column(at).to_numpy()) == keep))
        return df.mapInArrow(run, df.schema)
