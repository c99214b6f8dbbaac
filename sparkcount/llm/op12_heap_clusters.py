"""Centroid clustering of integer vectors with heap-ordered bounds.

Lloyd rounds in exact integers, without rescanning every vector.  A vector keeps
one number: its gap (distance to the second nearest centroid minus distance to
its own), plus its cluster's accumulated drift when the gap was taken.  A round
adds to a cluster's drift its own move and the longest move of another centroid;
while the drift stays below a vector's number, no other centroid can have become
as near, and the vector is not looked at.  A cluster's heap is a set of written
runs, sorted by (cluster, number): popping all numbers below the drift is a
range filter that Parquet's statistics prune.  Only popped vectors are rescanned
exactly, and go to a new run; their old rows are dead because their number lies
below the drift.  Centroid sums change by the popped vectors alone.

Bounds: the centroids (``k`` times ``dim`` integers) and their sums reach the
driver; a task holds one Arrow batch and distances of 4096 vectors at a time.

Defined cases: vectors that are null, of another length, or hold a null or
non-finite component are left out; components are held to +-2**26 so that a
squared distance fits a long; fewer vectors than ``k`` give as many centroids;
equal distances go to the smaller number; repeated rows count each; a null id
hashes as an empty one; no vector, no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkcount.llm.storage import Work

LARGEST = 1 << 26
STRIP = 4096
# Relative and absolute slack of a gap, far above the rounding of square roots.
SLACK = 1e-9


def integer_vectors(vectors: DataFrame, dim: int, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """``(id, v)``: ``floor(scale * x)`` of every component of the usable vectors."""
    v = F.col("v")
    held = F.transform(v, lambda x: F.floor(
        F.greatest(F.least(x * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("int"))
    usable = (F.size(v) == dim) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where(
        v.isNotNull() & usable).select("id", held.alias("v"))


def seeds(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of ``seed:id``."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return np.array([r["v"] for r in kept.select(h.alias("h"), "v").orderBy("h", "v").limit(k).collect()], np.int64)


def _matrix(column, dim: int) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.int64).reshape(-1, dim)


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances; in doubles where no intermediate passes 2**53."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    kind = np.float64 if 4 * x.shape[1] * top * top < 1 << 53 else np.int64
    x, c = x.astype(kind), c.astype(kind)
    d = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :]
    return d.astype(np.int64)


def _scan(dim: int, centroids: np.ndarray, drift: np.ndarray):
    """Exact nearest centroid of every row, and its heap number."""
    def kernel(batches):
        for batch in batches:
            x = _matrix(batch.column(1), dim)
            near, number = np.empty(len(x), np.int32), np.empty(len(x))
            for i in range(0, len(x), STRIP):
                d = _distances(x[i:i + STRIP], centroids)
                at = np.argmin(d, axis=1)
                own = np.sqrt(np.take_along_axis(d, at[:, None], 1)[:, 0])
                if len(centroids) > 1:
                    other = np.sqrt(np.partition(d, 1, axis=1)[:, 1])
                    gap = other - own - SLACK * (1 + other + own)
                else:
                    gap = np.full(len(own), np.inf)
                near[i:i + STRIP], number[i:i + STRIP] = at, drift[at] + gap
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(near), pa.array(number)],
                names=["id", "v", "old", "cluster", "number"])
    return kernel


def _moves(dim: int, k: int):
    """Per task: what its rows add to and take from every cluster's sums and size."""
    def kernel(batches):
        total = np.zeros((k, dim + 1), np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            old, new = (np.asarray(batch.column(i)) for i in (1, 2))
            moved = old != new
            for cluster in range(k):
                into, out = moved & (new == cluster), moved & (old == cluster)
                total[cluster, :dim] += x[into].sum(0) - x[out].sum(0)
                total[cluster, dim] += into.sum() - out.sum()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], names=["at", "n"])
    return kernel


def _own(dim: int, centroids: np.ndarray):
    def kernel(batches):
        for batch in batches:
            gap = _matrix(batch.column(1), dim) - centroids[np.asarray(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array((gap * gap).sum(1))],
                names=["id", "cluster", "distance"])
    return kernel


def _beyond(limits: np.ndarray, popped: bool) -> Column:
    """Rows whose number is (not) above their cluster's drift, as one Parquet filter."""
    side = "<=" if popped else ">"
    return F.expr(" or ".join(
        f"(cluster = {c} and number {side} {float(x)!r}D)" for c, x in enumerate(limits)))


class HeapClusters:
    """Clusters of ``kept (id, v)``; ``runs`` are the heaps, ``rescanned`` the rows per assignment."""

    def __init__(self, kept: DataFrame, dim: int, centroids: np.ndarray, work: Work):
        self.kept, self.dim, self.work = kept, dim, work
        self.centroids = centroids
        self.k = len(centroids)
        self.drift = np.zeros(self.k)
        self.sums = [[0] * (dim + 1) for _ in range(self.k)]
        self.runs: list[DataFrame] = []
        self.rescanned: list[int] = []
        self._upto: list[np.ndarray | None] = []

    def _alive(self) -> list[DataFrame]:
        return [run if at is None else run.where(_beyond(at, False)) for run, at in zip(self.runs, self._upto)]

    def assign(self) -> None:
        """Rescan the vectors whose gap has expired; at first all of them."""
        if self.runs:
            rows = reduce(DataFrame.unionByName, [
                run.where(_beyond(self.drift, True)) for run in self._alive()]).select(
                "id", "v", F.col("cluster").alias("old"))
            self._upto = [self.drift.copy() for _ in self.runs]
        else:
            rows = self.kept.select("id", "v", F.lit(-1).alias("old"))
        kind = self.kept.schema["id"].dataType.simpleString()
        found = rows.mapInArrow(_scan(self.dim, self.centroids, self.drift),
                                f"id {kind}, v array<int>, old int, cluster int, number double")
        run = self.work.cut(found.sortWithinPartitions("cluster", "number"), "run")
        self.runs.append(run)
        self._upto.append(None)
        moves = run.select("v", "old", "cluster").mapInArrow(_moves(self.dim, self.k), "at bigint, n bigint")
        for r in moves.groupBy("at").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect():
            self.sums[r["at"] // (self.dim + 1)][r["at"] % (self.dim + 1)] += int(r["n"])

    def update(self) -> None:
        """Every non-empty centroid becomes its vectors' floored mean; drifts grow."""
        new = np.array([[s // row[-1] for s in row[:-1]] if row[-1] else list(c)
                        for row, c in zip(self.sums, self.centroids)], np.int64)
        step = np.sqrt(((new - self.centroids).astype(np.float64) ** 2).sum(1)) * (1 + SLACK)
        for c in range(self.k):
            others = np.delete(step, c)
            self.drift[c] += step[c] + (others.max() if len(others) else 0.0)
        self.centroids = new

    def distances(self) -> DataFrame:
        """``(id, cluster, distance)`` of every vector, from the heaps' living rows."""
        kind = self.kept.schema["id"].dataType.simpleString()
        rows = reduce(DataFrame.unionByName, self._alive()).select("id", "v", "cluster")
        return rows.mapInArrow(_own(self.dim, self.centroids), f"id {kind}, cluster int, distance bigint")


def heap_clusters(vectors: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64, seed: int = 1,
                  id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(<id_col>, cluster, distance, cluster_inertia, inertia, centroid_sha256)``."""
    kept = integer_vectors(vectors, dim, scale, id_col, vec_col)
    first = seeds(kept, k, seed)
    if not len(first):
        return kept.limit(0).select(
            F.col("id").alias(id_col), F.lit(0).alias("cluster"),
            *[F.lit(0).cast("bigint").alias(c) for c in ("distance", "cluster_inertia", "inertia")],
            F.lit("").alias("centroid_sha256"))
    work = Work(vectors.sparkSession, "heap")
    state = HeapClusters(kept, dim, first, work)
    state.assign()
    for _ in range(rounds):
        state.update()
        state.assign()
    rows = work.cut(state.distances(), "distances")
    inertia = [0] * state.k
    for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect():
        inertia[r["cluster"]] = int(r["n"])
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in state.centroids.tolist()]

    def pick(values, kind):
        return F.expr(f"element_at(array({', '.join(repr(v) for v in values)}), cluster + 1)").cast(kind)

    return rows.select(
        F.col("id").alias(id_col), "cluster", "distance", pick(inertia, "bigint").alias("cluster_inertia"),
        F.lit(sum(inertia)).cast("bigint").alias("inertia"), pick(digests, "string").alias("centroid_sha256"))
