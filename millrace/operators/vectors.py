"""Nearest vectors by cosine: cells that k-means finds in a bounded sample, every vector in one, queries in the cells nearest to them.

Cells are fitted on the ``SAMPLE`` vectors with the smallest hashes of their ids (all, if there are fewer); the model is at most
``CELLS`` unit vectors and is all that is broadcast.  Every vector of the store is assigned to the cell of largest cosine.  A query goes to its
``probes`` best cells and meets their members there; with as many probes as cells the search is exact.  Members and queries of one cell meet in
one task; a cell with more than ``TOGETHER`` of either is split over salts, to each of which the other side goes.

Vectors that are null or zero, have a null component or another length than most have no cosine.  Equal cosines (to 12 digits) go by id."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared import kept

SAMPLE, CELLS, ROUNDS = 1 << 16, 4096, 8
#: Members or queries of a cell that one task holds.
TOGETHER = 20_000
#: Share of the cells that a query looks into, and cells at least.  Half of them is what vectors without any groups ask for (recall at 5 on the test
#: tables 0.93); where there are groups, a few ``probes`` do.
SHARE, LEAST = 0.5, 8
_PLACED = "id long, vec binary, cell int"


def unit(rows: pa.Array, size: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as unit rows, and the places of those that have a direction and the usual length (``size``, or the greatest)."""
    lists = rows.to_pylist()
    size = size or max((len(x) for x in lists if x), default=0)
    good = np.array([x is not None and len(x) == size > 0 and None not in x for x in lists], bool)
    v = np.array([lists[i] for i in np.flatnonzero(good)], np.float64).reshape(int(good.sum()), size)
    with np.errstate(invalid="ignore"):
        norm = np.linalg.norm(v, axis=1)
    some = (norm > 0) & np.isfinite(norm)
    return v[some] / norm[some, None], np.flatnonzero(good)[some]


def fit(v: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit middles of ``cells`` groups of unit rows (spherical k-means from rows spread evenly)."""
    middles = v[np.linspace(0, len(v) - 1, cells).astype(int)].copy()
    for _ in range(rounds):
        best = np.concatenate([(v[a : a + 8192] @ middles.T).argmax(axis=1) for a in range(0, len(v), 8192)])
        order = np.argsort(best, kind="stable")
        used, first = np.unique(best[order], return_index=True)
        sums = np.add.reduceat(v[order], first, axis=0)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        middles[used] = np.where(norm > 0, sums / np.maximum(norm, 1e-300), middles[used])
    return middles


@dataclass
class Index:
    """A store dealt into cells: ``rows`` (id, vec, cell, salt), the cells' middles and sizes."""

    rows: DataFrame
    middles: np.ndarray
    sizes: np.ndarray
    together: int

    @classmethod
    def of(cls, store: DataFrame, cells: int | None = None, sample: int = SAMPLE, together: int = TOGETHER) -> "Index":
        """``store`` (vec_id, vec).  ``cells``: the square root of the number of rows if it is not given, ``CELLS`` at most."""
        spark = store.sparkSession
        store = store.select(F.col("vec_id").cast("long").alias("id"), "vec")
        drawn = store.orderBy(F.xxhash64("id"), "id").limit(sample).select("vec").toArrow().column("vec")
        v, _ = unit(drawn.combine_chunks() if isinstance(drawn, pa.ChunkedArray) else drawn)
        if not len(v):
            return cls(spark.createDataFrame([], f"{_PLACED}, salt int"), np.zeros((0, 0)), np.zeros(0, np.int64), together)
        n = cells or int(np.sqrt(store.count()))
        middles = fit(v, max(1, min(n, CELLS, len(v))))
        rows = kept(store.mapInArrow(_placed(spark.sparkContext.broadcast(middles), 1), _PLACED), "cells")
        sizes = np.zeros(len(middles), np.int64)
        for cell, count in rows.groupBy("cell").count().collect():
            sizes[cell] = count
        return cls(_salted(rows, sizes, together), middles, sizes, together)

    def search(self, queries: DataFrame, k: int = 5, probes: int | None = None, exact: bool = False) -> DataFrame:
        """``queries`` (query_id, qvec): ``query_id, vec_id, cosine, rank`` of the ``k`` best found for each."""
        spark, n = queries.sparkSession, len(self.middles)
        if not n:
            return spark.createDataFrame([], "query_id long, vec_id long, cosine double, rank int")
        probes = n if exact else min(n, probes or max(LEAST, round(SHARE * n)))
        queries = queries.select(F.col("query_id").cast("long").alias("id"), F.col("qvec").alias("vec"))
        asked = kept(queries.mapInArrow(_placed(spark.sparkContext.broadcast(self.middles), probes), _PLACED), "probes")
        counts = np.zeros(n, np.int64)
        for cell, count in asked.groupBy("cell").count().collect():
            counts[cell] = count
        # Every part of a cell's members meets every part of its queries.
        mine, theirs = _parts(self.sizes, self.together), _parts(counts, self.together)
        left = _salted(asked, counts, self.together).withColumnRenamed("salt", "part").withColumn("salt", F.explode(F.sequence(F.lit(0), _of(mine) - 1)))
        right = self.rows.withColumn("part", F.explode(F.sequence(F.lit(0), _of(theirs) - 1)))
        key = ["cell", "salt", "part"]
        met = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_best(k), "query_id long, vec_id long, cosine double")
        w = Window.partitionBy("query_id").orderBy(F.col("cosine").desc(), "vec_id")
        return met.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _parts(sizes: np.ndarray, together: int) -> np.ndarray:
    return np.maximum(1, -(-sizes // together))


def _of(parts: np.ndarray):
    """A cell's number of parts, from the few that have more than one."""
    found = F.lit(1)
    many = np.flatnonzero(parts > 1)
    if len(many):
        named = F.create_map(*[F.lit(int(x)) for c in many for x in (c, parts[c])])
        found = F.coalesce(F.element_at(named, F.col("cell")), found)
    return found


def _salted(rows: DataFrame, sizes: np.ndarray, together: int) -> DataFrame:
    return rows.withColumn("salt", F.pmod(F.xxhash64("id", "vec"), _of(_parts(sizes, together))).cast("int"))


def _placed(shared, probes: int):
    """Rows with a direction, once for each of their ``probes`` best cells; vectors as the bytes of their unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middles = shared.value
        for batch in batches:
            for a in range(0, batch.num_rows, 2048):
                part = batch.slice(a, 2048)
                v, at = unit(part.column("vec"), middles.shape[1])
                if not len(v):
                    continue
                best = np.argsort(-(v @ middles.T), axis=1, kind="stable")[:, :probes]
                ids = part.column("id").take(pa.array(at))
                which = np.repeat(np.arange(len(v)), best.shape[1])
                packed = pa.array([x.tobytes() for x in v], pa.binary())
                yield pa.record_batch({"id": ids.take(pa.array(which)), "vec": packed.take(pa.array(which)), "cell": pa.array(best.ravel().astype(np.int32))})

    return run


def _best(k: int):
    """The ``k`` best members of a part of a cell for each of its queries."""

    def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        packed = table.column("vec").to_pylist()
        return table.column("id").to_numpy(), np.frombuffer(b"".join(packed), np.float64).reshape(len(packed), -1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if left.num_rows and right.num_rows:
            (ids, q), (own, v) = matrix(left), matrix(right)
            for a in range(0, len(q), 256):
                cosine = np.round(q[a : a + 256] @ v.T, 12)
                if len(own) > 4 * k:  # all that could be among the best: as good as the k-th
                    edge = np.partition(cosine, -k, axis=1)[:, -k]
                    row, at = np.nonzero(cosine >= edge[:, None])
                else:
                    row, at = np.divmod(np.arange(cosine.size), len(own))
                order = np.lexsort((own[at], -cosine[row, at], row))
                row, at = row[order], at[order]
                place = np.arange(len(row)) - np.searchsorted(row, row)
                row, at = row[place < k], at[place < k]
                out.append((ids[a + row], own[at], cosine[row, at]))
        columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table([pa.array(x) for x in columns], ["query_id", "vec_id", "cosine"])

    return run


def nearest(queries: DataFrame, store: DataFrame, k: int = 5, probes: int | None = None, exact: bool = True) -> DataFrame:
    """``queries`` (query_id, qvec) against ``store`` (vec_id, vec): the ``k`` of largest cosine each, with ``rank``."""
    return Index.of(store).search(queries, k, probes, exact)
