"""Operator 12: exact centroid clustering with bounds that geometry loosens by less than the centroids' full drift."""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import cut_lineage, with_workers

BLOCK = 4096  # vectors in a block, at most
SCALE = 1024
SEGMENTS = 4  # pieces of a centroid's way, each bounded by itself
SLACK = 1e-7  # of a distance: far above what rounding of doubles takes


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, ``(len(x), len(centroids))`` as 64-bit integers."""
    d = np.empty((len(x), len(centroids)), np.int64)
    for j, c in enumerate(centroids):
        diff = x - c
        d[:, j] = np.einsum("ij,ij->i", diff, diff)
    return d


def loosening(old: np.ndarray, new: np.ndarray, own: int, radius: float, segments: int = SEGMENTS) -> np.ndarray:
    """How much nearer each centroid can have come, at most, to a point within ``radius`` of ``old[own]``.

    A centroid that goes from p a way s along the unit vector e comes nearer
    to x at the rate cos(angle at p + s e between e and x). All x of the
    sphere lie within asin(radius / distance) of the direction of its centre
    as seen from there, so the rate is at most the cosine of the angle to the
    centre less that; in the plane through e and the centre these are two
    triangles. The angle to the centre only grows on the way, so its value at
    the start of each of ``segments`` pieces and the shortest distance on the
    piece bound the piece. A negative value says that the centroid went away.
    The full drift counts where a piece meets the sphere.
    """
    way = (new - old).astype(np.float64)
    drift = np.sqrt((way ** 2).sum(axis=1))
    safe = np.maximum(drift, 1e-300)
    to_centre = (old[own] - old).astype(np.float64)
    along = (to_centre * way).sum(axis=1) / safe
    across = np.sqrt(np.maximum((to_centre ** 2).sum(axis=1) - along ** 2, 0.0))
    total = np.zeros(len(old))
    step = drift / segments
    for i in range(segments):
        ahead = along - i * step
        nearest = np.hypot(ahead - np.clip(ahead, 0.0, step), across)
        seen = np.arcsin(np.minimum(1.0, radius / np.maximum(nearest, 1e-300)))
        angle = np.maximum(0.0, np.arctan2(across, ahead) - seen)
        total += np.where(radius >= nearest, step, step * np.cos(angle))
    return total + SLACK * drift


def first_assignment(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (the smaller number of equals), the distance to it, and to the next."""
    d = squared_distances(x, centroids)
    a = d.argmin(axis=1)
    at = np.arange(len(x))
    upper = np.sqrt(d[at, a].astype(np.float64))
    d[at, a] = np.iinfo(np.int64).max
    lower = np.sqrt(d.min(axis=1).astype(np.float64)) if len(centroids) > 1 else np.full(len(x), np.inf)
    return a, upper, lower


def follow(x: np.ndarray, a: np.ndarray, upper: np.ndarray, lower: np.ndarray, old: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Assignment and bounds after the centroids went from ``old`` to ``new``, and how many vectors were scanned.

    ``upper`` is at least a vector's distance to its centroid, ``lower`` at
    most that to any other. Each cluster's vectors lie in a sphere about their
    old centroid as wide as the largest upper bound among them; the sphere's
    ``loosening`` serves them all. A vector whose bounds still part needs
    nothing; of the others the distance to their own centroid is made exact,
    and where that is not enough all distances are.
    """
    a, upper, lower = a.copy(), upper.copy(), lower.copy()
    k = len(old)
    drift = np.sqrt(((new - old).astype(np.float64) ** 2).sum(axis=1))
    upper += drift[a] * (1 + SLACK)
    half = np.full(k, np.inf)  # half the way to the nearest other centroid
    for j in range(k if k > 1 else 0):
        mine = np.flatnonzero(a == j)
        if len(mine):
            nearer = loosening(old, new, j, float((upper[mine] - drift[j]).max()) * (1 + SLACK))
            lower[mine] -= np.delete(nearer, j).max()
        apart = np.sqrt(((new - new[j]).astype(np.float64) ** 2).sum(axis=1))
        half[j] = np.delete(apart, j).min() / 2

    def unsure(at: np.ndarray) -> np.ndarray:
        return at[upper[at] * (1 + SLACK) >= np.maximum(lower[at], half[a[at]]) * (1 - SLACK)]
    open_ = unsure(np.arange(len(x)))
    diff = x[open_] - new[a[open_]]
    upper[open_] = np.sqrt(np.einsum("ij,ij->i", diff, diff).astype(np.float64))
    open_ = unsure(open_)
    if len(open_):
        a[open_], upper[open_], lower[open_] = first_assignment(x[open_], new)
    return a, upper, lower, len(open_)


def sums_of(x: np.ndarray, a: np.ndarray, k: int) -> np.ndarray:
    """Count and component sums of each cluster, ``(k, 1 + dim)``."""
    out = np.zeros((k, 1 + x.shape[1]), np.int64)
    for j in range(k):
        mine = a == j
        out[j, 0], out[j, 1:] = mine.sum(), x[mine].sum(axis=0, dtype=np.int64)
    return out


def kept_vectors(vectors: DataFrame, dim: int, vec_id: str, embedding: str) -> DataFrame:
    """``id, v`` of the vectors with exactly ``dim`` components, all of them finite."""
    x = F.col(embedding)
    finite = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    return vectors.where((F.size(x) == dim) & finite).select(F.col(vec_id).alias("id"), F.col(embedding).alias("v"))


def _integers(flat: np.ndarray, dim: int) -> np.ndarray:
    x = np.floor(flat.astype(np.float64) * SCALE).reshape(-1, dim)
    most = isqrt((1 << 62) // dim) // 2  # squared distances of smaller components stay below 2^62
    if len(x) and np.abs(x).max() > min(most, (1 << 31) - 1):
        raise ValueError(f"a component is beyond {most / SCALE:.0f}: its squared distances don't fit 64 bits")
    return x.astype(np.int32)


def cluster_vectors(vectors: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, seed: str = "3:",
                    vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Lloyd's clustering in exact integers, one row per kept vector.

    Kept are vectors with ``dim`` components, none null or non-finite; each
    component x becomes floor(1024 x). The ``k`` vectors with the smallest
    sha256 of ``seed`` and id (a null id as empty text; equal ids by vector)
    are the first centroids; fewer vectors make fewer clusters. A round
    assigns every vector to the nearest centroid (of equals the smaller
    number) and moves each non-empty centroid to the floored mean. After the
    last round vectors are assigned once more. Returns ``vec_id, cluster,
    distance, cluster_inertia, inertia, centroid_sha256``; no kept vectors
    give no rows; repeated rows are vectors of their own. Components whose
    distances would not fit 64 bits raise an error.

    Vectors travel in blocks of ``BLOCK`` with their assignment and bounds
    (``follow``), a round is one map over them, and only what a round changes
    in the sums of clusters is added up. A round's blocks are cached for the
    next and made again from the input where an executor is lost; nothing is
    shuffled but sums. The result is checkpointed.
    """
    spark = with_workers(vectors.sparkSession)
    kept = kept_vectors(vectors, dim, vec_id, embedding)
    sha = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = kept.select(sha.alias("sha"), "v").orderBy("sha", "v").limit(k).collect()
    kind = vectors.schema[vec_id].dataType
    if not first:
        return spark.createDataFrame([], f"vec_id {kind.simpleString()}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = _integers(np.array([r["v"] for r in first]).ravel(), dim).astype(np.int64)
    ddl = f"ids array<{kind.simpleString()}>, x binary, a binary, upper binary, lower binary, change binary"

    def block(ids: pa.Array, x: np.ndarray, a: np.ndarray, upper: np.ndarray, lower: np.ndarray, change: np.ndarray) -> pa.RecordBatch:
        blobs = [pa.array([y.tobytes()], pa.binary()) for y in (x, a.astype(np.int32), upper, lower, change)]
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), *blobs],
                                          names=["ids", "x", "a", "upper", "lower", "change"])

    def opened(b: pa.RecordBatch) -> Iterator[tuple]:
        for i in range(b.num_rows):
            x, a, upper, lower = (np.frombuffer(b.column(n)[i].as_buffer(), t) for n, t in ((1, np.int32), (2, np.int32), (3, np.float64), (4, np.float64)))
            yield b.column(0)[i].values, x.reshape(-1, dim), a.astype(np.int64), upper, lower

    def start(batches: Iterator, c: np.ndarray = centroids) -> Iterator:
        for b in batches:
            for lo in range(0, b.num_rows, BLOCK):
                part = b.slice(lo, BLOCK)
                x = _integers(part.column(1).flatten().to_numpy(zero_copy_only=False), dim)
                a, upper, lower = first_assignment(x, c)
                yield block(part.column(0), x, a, upper, lower, sums_of(x, a, len(c)))

    def move(old: np.ndarray, new: np.ndarray):
        def run(batches: Iterator) -> Iterator:
            for b in batches:
                for ids, x, a, upper, lower in opened(b):
                    now, upper, lower, _ = follow(x, a, upper, lower, old, new)
                    moved = now != a
                    change = sums_of(x[moved], now[moved], len(new)) - sums_of(x[moved], a[moved], len(new))
                    yield block(ids, x, now, upper, lower, change)
        return run

    def changes(batches: Iterator) -> Iterator:
        total = None
        for b in batches:
            for i in range(b.num_rows):
                y = np.frombuffer(b.column(0)[i].as_buffer(), np.int64)
                total = y if total is None else total + y
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["at", "n"])

    def totals(df: DataFrame) -> np.ndarray:
        out = np.zeros((len(centroids), 1 + dim), np.int64)
        for r in df.select("change").mapInArrow(changes, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
            out.ravel()[r["at"]] = r["n"]  # one row per centroid and component, whatever the input
        return out

    blocks = kept.mapInArrow(start, ddl).persist(StorageLevel.MEMORY_AND_DISK)
    sums = totals(blocks)
    for _ in range(rounds):
        new = np.where(sums[:, :1] > 0, sums[:, 1:] // np.maximum(sums[:, :1], 1), centroids)
        if np.array_equal(new, centroids):
            break  # the rounds left would change nothing
        step = blocks.mapInArrow(move(centroids, new), ddl).persist(StorageLevel.MEMORY_AND_DISK)
        sums += totals(step)  # fills the cache before the blocks it is made of go
        blocks.unpersist()
        blocks, centroids = step, new

    def report(batches: Iterator, c: np.ndarray = centroids) -> Iterator:
        for b in batches:
            for ids, x, a, _, _ in opened(b):
                diff = x - c[a]
                yield pa.RecordBatch.from_arrays([ids, pa.array(a.astype(np.int32)), pa.array(np.einsum("ij,ij->i", diff, diff))],
                                                 names=["vec_id", "cluster", "distance"])
    found = cut_lineage(blocks.mapInArrow(report, f"vec_id {kind.simpleString()}, cluster int, distance long"))
    blocks.unpersist()
    per = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # k rows
    shas = spark.createDataFrame([(r["cluster"], r["cluster_inertia"], sum(x["cluster_inertia"] for x in per), ",".join(map(str, centroids[r["cluster"]].tolist())))
                                  for r in per], "cluster int, cluster_inertia long, inertia long, centroid string")
    return (found.join(F.broadcast(shas), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(F.col("centroid").cast("binary"), 256).alias("centroid_sha256")))


def _oracle(k: int = 8, rounds: int = 10) -> str:
    """The same as plain SQL: a chain of tables, two a round."""
    steps = [f"""
v AS (SELECT row_number() OVER (ORDER BY sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')), embedding) - 1 AS r, vec_id,
             list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
      FROM embeddings
      WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
e AS (SELECT r, unnest(generate_series(1, 64)) AS i, unnest(x) AS x FROM v),
c0 AS (SELECT r AS c, i, x FROM e WHERE r < {k})"""]

    def assigned(n: int) -> str:
        return f"""
a{n} AS (SELECT r, c, d FROM (SELECT r, c, d, row_number() OVER (PARTITION BY r ORDER BY d, c) AS k
         FROM (SELECT e.r, t.c, CAST(sum((e.x - t.x) * (e.x - t.x)) AS BIGINT) AS d FROM e JOIN c{n} t USING (i) GROUP BY e.r, t.c)) WHERE k = 1)"""
    for n in range(rounds):
        steps.append(assigned(n))
        steps.append(f"""
c{n + 1} AS (SELECT o.c, o.i, coalesce(m.x, o.x) AS x FROM c{n} o LEFT JOIN
         (SELECT a.c, e.i, CAST((sum(e.x) - ((sum(e.x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x
          FROM a{n} a JOIN e USING (r) GROUP BY a.c, e.i) m USING (c, i))""")
    steps.append(assigned(rounds))
    return "WITH " + ",".join(steps) + f"""
SELECT v.vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, s.h AS centroid_sha256
FROM a{rounds} a JOIN v USING (r)
JOIN (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY c) s USING (c)
"""


ORACLE_SQL = _oracle()
