"""Centroid clustering (Lloyd's rounds) on integer vectors, with distances filtered in a PCA-rotated space.

Components x become floor(``scale`` * x).  The vectors' covariance, summed over all of them,
gives an orthogonal rotation; beside its integers each vector stores its ``LEADING`` first
rotated coordinates and the norm of the rest.  For a vector and a centroid the squared
distance of their leading coordinates plus the squared difference of their residual norms
is a lower bound of the squared distance.  The centroid with the least bound is measured
first; of the others only those whose bound does not exceed that distance (less a margin for
rounding) are measured, in integers.  So the rotation saves work and decides nothing.

A round assigns the vectors where they are read and adds up sums and counts of each cluster
in the task; what is shuffled is one row a task and cluster, what reaches the driver is k rows.
Vectors and their rotated form are staged once and read by every round.

Defined results: kept are vectors with exactly ``dim`` components, none null or not finite, and
none whose integer exceeds ``LIMIT`` in size (such distances do not fit 64 bits); the others have
no row.  A null id counts as the empty text where ids choose the first centroids, equal hashes
are ordered by the components.  With fewer than k vectors there are as many centroids as vectors; an empty
table gives an empty result; repeated rows count and are assigned each for itself; extra columns are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import pick, staged

SCALE = 64
LEADING = 24               # rotated coordinates that a vector stores
LIMIT = 1 << 26            # 64 components of twice this size, squared, still fit 64 bits; larger vectors are left out
BLOCK = 4096               # vectors measured at once


def kept_vectors(vectors: DataFrame, dim: int, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and v (array of int): the usable vectors as integers."""
    v = F.col("v")
    rows = pick(vectors, vec_id=id_col, v=vector_col).withColumn("v", v.cast("array<double>")).where(F.size(v) == dim)
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) > LIMIT / scale)
    return rows.where(~F.exists(v, bad)).select("vec_id", F.transform(v, lambda x: F.floor(x * F.lit(float(scale))).cast("int")).alias("v"))


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.int64)


# ---------------------------------------------------------------- rotation
def rotation(kept: DataFrame, dim: int) -> np.ndarray:
    """Columns: the principal axes of all vectors, the widest first.  A task adds up its own moments; the driver gets dim * dim sums."""
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim + 1, dim + 1))
        for batch in batches:
            x = np.hstack([np.ones((batch.num_rows, 1)), _matrix(batch, dim)])
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["cell", "s"])

    rows = kept.mapInArrow(moments, "cell long, s double").groupBy("cell").agg(F.sum("s").alias("s")).collect()
    total = np.zeros((dim + 1) ** 2)
    for cell, s in rows:
        total[cell] = s
    total = total.reshape(dim + 1, dim + 1)
    n = max(total[0, 0], 1.0)
    mean = total[0, 1:] / n
    return np.linalg.eigh(total[1:, 1:] / n - np.outer(mean, mean))[1][:, ::-1]


def _rotated(x: np.ndarray, axes: np.ndarray, leading: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading rotated coordinates, and the norm of the rest."""
    y = x @ axes
    return y[:, :leading], np.sqrt((y[:, leading:] ** 2).sum(axis=1))


_STORED = "vec_id {}, v array<int>, lead array<float>, rest float"


def store(kept: DataFrame, axes: np.ndarray, leading: int) -> DataFrame:
    """The staged table of a clustering: vec_id, the integers, leading rotated coordinates and residual norm."""
    dim = len(axes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead, rest = _rotated(_matrix(batch, dim), axes, leading)
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * leading)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"),
                                              pa.ListArray.from_arrays(ends, pa.array(lead.ravel().astype(np.float32))),
                                              pa.array(rest.astype(np.float32))], names=["vec_id", "v", "lead", "rest"])

    return staged(kept.mapInArrow(run, _STORED.format(kept.schema["vec_id"].dataType.simpleString())), "centroid-vectors")


# ---------------------------------------------------------------- assignment
@dataclass
class Model:
    """Integer centroids and the rotation that measures them.  Its size is k * dim + dim * dim numbers, whatever the table."""
    centroids: np.ndarray
    axes: np.ndarray
    leading: int

    def nearest(self, x: np.ndarray, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Cluster, squared distance (both exact; ties: the smaller number), and how many distances were measured."""
        c_lead, c_rest = _rotated(self.centroids, self.axes, self.leading)
        lead, rest = lead.astype(np.float64), rest.astype(np.float64)
        square = (lead ** 2).sum(axis=1)[:, None] + (c_lead ** 2).sum(axis=1)[None, :]
        bound = square - 2 * lead @ c_lead.T + (rest[:, None] - c_rest[None, :]) ** 2
        # Stored coordinates are rounded to 24 bits: a bound may be off by that share of the squared norms.
        margin = 1e-5 * (square + rest[:, None] ** 2 + c_rest[None, :] ** 2) + 1e-6
        at = np.arange(len(x))
        best = (bound - margin).argmin(axis=1)
        distance = self._measure(x, at, best)
        measured = len(x)
        maybe = bound - margin <= distance[:, None]
        maybe[at, best] = False
        for c in np.flatnonzero(maybe.any(axis=0)).tolist():
            rows = np.flatnonzero(maybe[:, c])
            d = self._measure(x, rows, c)
            measured += len(rows)
            nearer = (d < distance[rows]) | ((d == distance[rows]) & (c < best[rows]))
            distance[rows[nearer]], best[rows[nearer]] = d[nearer], c
        return best, distance, measured

    def _measure(self, x: np.ndarray, rows: np.ndarray, c) -> np.ndarray:
        return ((x[rows] - self.centroids[c]) ** 2).sum(axis=1)


def _blocks(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    dim = model.centroids.shape[1]
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            x = _matrix(part, dim)
            lead = part.column("lead").flatten().to_numpy(zero_copy_only=False).reshape(-1, model.leading)
            yield part, x, *model.nearest(x, lead, part.column("rest").to_numpy(zero_copy_only=False))[:2]


def _moved(stored: DataFrame, model: Model) -> np.ndarray:
    """The centroids after a round: floor(sum / count) of their vectors; empty ones stay."""
    k, dim = model.centroids.shape
    shared = stored.sparkSession.sparkContext.broadcast(model)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for _, x, cluster, _ in _blocks(batches, shared.value):
            n += np.bincount(cluster, minlength=k)
            for c in np.unique(cluster).tolist():
                total[c] += x[cluster == c].sum(axis=0)
        cells = np.hstack([total, n[:, None]])
        here = np.flatnonzero(n)
        at = (here[:, None] * (dim + 1) + np.arange(dim + 1)).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(cells[here].ravel())], names=["cell", "s"])

    rows = stored.mapInArrow(sums, "cell long, s long").groupBy("cell").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    cells = {cell: int(s) for cell, s in rows}
    out = model.centroids.copy()
    for c in range(k):
        n = cells.get(c * (dim + 1) + dim, 0)
        if n:
            out[c] = [cells[c * (dim + 1) + i] // n for i in range(dim)]
    return out


def _assigned(stored: DataFrame, model: Model) -> DataFrame:
    shared = stored.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, cluster, distance in _blocks(batches, shared.value):
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                                             names=["vec_id", "cluster", "distance"])

    return stored.select("vec_id", "v", "lead", "rest").mapInArrow(
        run, f"vec_id {stored.schema['vec_id'].dataType.simpleString()}, cluster int, distance long")


@dataclass
class Clustering:
    """``assigned``: vec_id, cluster, distance (staged); ``model``: the final centroids."""
    assigned: DataFrame
    model: Model


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, scale: int = SCALE, leading: int = LEADING, seed: str = "1",
            id_col: str = "vec_id", vector_col: str = "embedding") -> Clustering:
    """``rounds`` rounds from the k kept vectors with the smallest sha256 of ``<seed>:<id>``, and a last assignment."""
    kept = kept_vectors(vectors, dim, scale, id_col, vector_col)
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = kept.orderBy(key, "v").limit(k).collect()
    axes, leading = rotation(kept, dim), min(leading, dim)
    stored = store(kept, axes, leading)
    centroids = np.array([r["v"] for r in first], np.int64).reshape(-1, dim)
    if not len(centroids):
        kind = stored.schema["vec_id"].dataType.simpleString()
        return Clustering(stored.sparkSession.createDataFrame([], f"vec_id {kind}, cluster int, distance long"), Model(centroids, axes, leading))
    for _ in range(rounds):
        centroids = _moved(stored, Model(centroids, axes, leading))
    model = Model(centroids, axes, leading)
    return Clustering(staged(_assigned(stored, model), "centroid-assigned"), model)


def report(found: Clustering) -> DataFrame:
    """The assignment with cluster_inertia, inertia (distances summed over the cluster and over all) and the centroid's sha256."""
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.model.centroids.tolist()]
    sums = found.assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    total = sum(int(r["s"]) for r in sums)
    facts = [(r["cluster"], int(r["s"]), total, digests[r["cluster"]]) for r in sums]
    kinds = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    return found.assigned.join(F.broadcast(found.assigned.sparkSession.createDataFrame(facts, kinds)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
