"""Centroid clustering of whole-number vectors with Hamerly bounds.

Every vector keeps its cluster, one upper bound of the distance to its centroid and one lower bound of the distance to any other.
When centroids move, the upper bound grows by what the own centroid moved and the lower one shrinks by the most that another
moved; no distance is computed for that.  A vector whose upper bound is still below its lower bound, or below half of the way from
its centroid to the next one, stays where it is.  For the others the upper bound is made exact first, and those that are
still ambiguous are compared with all centroids in exact 64-bit integers, ties to the smaller number.  Bounds are
rounded outwards at every step, so they never decide what the integers would decide otherwise.

A round reads the vectors with their bounds from one table in the shared folder and writes the next, so a lost executor costs
that round's tasks.  No vector is shuffled: each task adds up its vectors by cluster, and the sums (one row per task,
cluster and component) are totalled as decimals; the driver sees centroids only.

Defined results: vectors that are null, of another length or with a null or non-finite component are left out; each row is a vector
of its own, repeated ids too; a null id counts as empty text in the order that picks the first centroids, and equal hashes are
ordered by components; fewer vectors than clusters give fewer clusters; an empty cluster keeps its centroid; an empty table gives
no row.  A component of 2^27 or more after scaling is an error: its squared distances would not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .core import discard, stored

DIMENSIONS, CLUSTERS, ROUNDS, SCALE = 64, 16, 3, 64
LARGEST = 1 << 27
#: Rounding outwards: more than the error of the root and of one sum or product.
_UP, _DOWN = 1 + 2.0**-48, 1 - 2.0**-48
STATE = "vec_id long, x array<int>, cluster int, distance long, upper double, lower double, scanned boolean"


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` and ``c`` (64-bit integers)."""
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)[None, :]


@dataclass(frozen=True)
class Centroids:
    """Centroids of a round and how far each has moved since the last (none before the first)."""

    points: np.ndarray
    moved: np.ndarray | None = None

    def half_way(self) -> np.ndarray:
        """Half of the distance of each to the next one, rounded down."""
        if len(self.points) < 2:
            return np.full(len(self.points), np.inf)
        d = np.sqrt(squared(self.points, self.points).astype(float))
        np.fill_diagonal(d, np.inf)
        return d.min(axis=1) / 2 * _DOWN

    def others_moved(self) -> np.ndarray:
        """The most that any but this one moved."""
        out = np.zeros(len(self.moved))
        for i in range(len(out)):
            out[i] = np.delete(self.moved, i).max(initial=0.0)
        return out

    def next(self, points: np.ndarray) -> "Centroids":
        step = points - self.points
        return Centroids(points, np.sqrt((step * step).sum(axis=1).astype(float)) * _UP)


def scan(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid, exact squared distance, and both bounds, by comparing with every centroid."""
    d = squared(x, c)
    best = d.argmin(axis=1)
    at = np.arange(len(x))
    nearest = d[at, best]
    if len(c) > 1:
        d[at, best] = np.iinfo(np.int64).max
        second = np.sqrt(d.min(axis=1).astype(float)) * _DOWN
    else:
        second = np.full(len(x), np.inf)
    return best, nearest, np.sqrt(nearest.astype(float)) * _UP, second


def assign(x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, c: Centroids):
    """One round for some vectors: cluster, both bounds, and which were scanned in full."""
    cluster = cluster.astype(np.int64)
    upper = (upper + c.moved[cluster]) * _UP
    lower = np.where(np.isinf(lower), lower, np.maximum(lower - c.others_moved()[cluster], 0) * _DOWN)
    enough = np.maximum(lower, c.half_way()[cluster])
    doubtful = np.flatnonzero(~(upper < enough))
    own = x[doubtful] - c.points[cluster[doubtful]]
    upper[doubtful] = np.sqrt((own * own).sum(axis=1).astype(float)) * _UP
    scanned = np.zeros(len(x), bool)
    scanned[doubtful[~(upper[doubtful] < enough[doubtful])]] = True
    if scanned.any():
        cluster[scanned], _, upper[scanned], lower[scanned] = scan(x[scanned], c.points)
    return cluster, upper, lower, scanned


def _matrix(column: pa.Array) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return x.reshape(len(column), -1)


def _round(c: Centroids):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 4096):
                batch = whole.slice(a, 4096)
                x = _matrix(batch.column("x"))
                if c.moved is None:
                    cluster, _, upper, lower = scan(x, c.points)
                    scanned = np.ones(len(x), bool)
                else:
                    given = [batch.column(n).to_numpy(zero_copy_only=False).copy() for n in ("cluster", "upper", "lower")]
                    cluster, upper, lower, scanned = assign(x, *given, c)
                own = x - c.points[cluster]
                yield pa.record_batch({
                    "vec_id": batch.column("vec_id"), "x": batch.column("x"), "cluster": pa.array(cluster.astype(np.int32)), "distance": pa.array((own * own).sum(axis=1)),
                    "upper": pa.array(upper), "lower": pa.array(lower), "scanned": pa.array(scanned),
                })

    return run


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        x, cluster = _matrix(batch.column("x")), batch.column("cluster").to_numpy()
        for k in np.unique(cluster).tolist():
            own = x[cluster == k]
            total[k] = total.get(k, 0) + np.append(own.sum(axis=0), len(own))
    for k, t in total.items():
        yield pa.record_batch({"cluster": pa.array(np.full(len(t), k, np.int32)), "place": pa.array(np.arange(len(t), dtype=np.int32)), "total": pa.array(t)})


def moved(state: DataFrame, c: Centroids) -> Centroids:
    """Centroids at the floored means of their vectors; those without vectors stay."""
    sums = state.select("x", "cluster").mapInArrow(_sums, "cluster int, place int, total long")
    points = c.points.copy()
    totals = {(k, p): int(t) for k, p, t in sums.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(19,0)")).alias("total")).collect()}
    size = points.shape[1]
    for k in {k for k, _ in totals}:
        points[k] = [totals[k, p] // totals[k, size] for p in range(size)]
    return c.next(points)


def whole_numbers(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``x``: the floor of each component times ``scale``, of vectors that are whole and finite."""
    v = F.col(vector_col).cast("array<double>")
    fits = (F.size(v) == dimensions) & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    made = F.transform(v, lambda e: F.when(F.abs(e * scale) < LARGEST, F.floor(e * scale).cast("int")).otherwise(F.raise_error(F.lit(f"a component times {scale} is {LARGEST} or more")).cast("int")))
    return rows.where(F.coalesce(fits, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), made.alias("x"))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: str = "1") -> np.ndarray:
    by_hash: Column = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return np.array([r["x"] for r in vectors.orderBy(by_hash, "x").limit(clusters).select("x").collect()], np.int64)


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> tuple[DataFrame, Centroids | None]:
    """Vectors (vec_id, x) with ``cluster``, the exact squared ``distance``, their bounds and whether the last round scanned them in full;
    and the final centroids, nothing if there are no vectors."""
    vectors = stored(vectors, "vectors")
    points = first_centroids(vectors, clusters)
    if not len(points):
        discard(vectors)
        return vectors.sparkSession.createDataFrame([], STATE), None
    c, state = Centroids(points), vectors
    for turn in range(rounds + 1):
        last, state = state, stored(state.mapInArrow(_round(c), STATE), "bounds")
        discard(last)
        if turn < rounds:
            c = moved(state, c)
    return state, c


def op12_centroid_clustering(spark, sf_dir: str) -> DataFrame:
    vectors = whole_numbers(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    state, c = cluster(vectors)
    sums = state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(19,0)")).alias("d")).collect()
    inertia = {k: int(d) for k, d in sums}
    named = [(k, d, sum(inertia.values()), hashlib.sha256(",".join(map(str, c.points[k].tolist())).encode()).hexdigest()) for k, d in inertia.items()]
    named = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.select("vec_id", "cluster", "distance").join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle(clusters: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    steps = [f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda v: floor({SCALE} * v::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = {DIMENSIONS}),
c0 AS MATERIALIZED (SELECT k - 1 AS k, x FROM (SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), x) AS k, x FROM kept) WHERE k <= {clusters})"""]  # fmt: skip
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT * FROM (SELECT r, vec_id, kept.x, k, list_sum(list_transform(list_zip(kept.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM kept, c{i} c)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1)""")
        if i < rounds:
            steps.append(f"""
c{i + 1} AS MATERIALIZED (
  SELECT k, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN (
    SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY p) AS x
    FROM (SELECT k, p, sum(v) AS s, count(*) AS n FROM (SELECT k, unnest(range({DIMENSIONS})) AS p, unnest(x) AS v FROM a{i}) GROUP BY k, p) GROUP BY k) m USING (k))""")
    return ",".join(steps) + f"""
SELECT vec_id, k::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
       sha256(list_aggregate(c.x, 'string_agg', ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} c USING (k)
"""


ORACLE = _oracle()
