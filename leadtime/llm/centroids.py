"""Clustering of vectors around centroids, which are searched through a vantage-point tree.

Vectors with exactly ``dim`` components, none null or not finite, take part; a component x becomes the integer
floor(64 x). Centroids 0, 1, ... start as the vectors whose SHA-256 of ``<seed>:<id>`` is smallest (equal ones in the
order of their components). In each round the driver builds a vantage-point tree over the centroids and broadcasts it:
``k`` rows of ``dim`` integers, so its size is set by the parameters. Tasks find the nearest centroid of every vector and
add up the components per centroid; the driver gets ``k`` rows of sums and floors the means exactly. An empty centroid
stays where it is.

The search is best-first for every vector: of the nodes it has met it opens the one with the least lower bound of the
distance, compares the node's vantage point by exact integer squared distance, ties going to the smaller centroid
number, and gives the two subtrees their bounds from the vantage point's radii. It ends when the least bound is greater
than the best distance; a bound that is equal, or smaller by no more than rounding may hide, is still opened, so no tie
and no nearer centroid is lost. Many vectors take their steps together in numpy.

Integers: components must lie within LARGEST, so that squared distances fit into 64 bits; a larger one ends the job
with an error that says so. Nulls: a vector that is null or holds a null is left out; a null id is kept and hashed as an
empty string. Rows with equal ids or equal vectors are vectors of their own. Fewer vectors than ``k`` give that many
centroids, an empty table an empty result. Columns beside id and vector are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadtime.plans.lineage import join_sized, materialize

CENTROIDS, ROUNDS, DIM, SCALE = 16, 3, 64, 64
#: Largest size of a component, for 64 components.
LARGEST = 1 << 27
#: Centroids below which a subtree is a list, and cells of the search table of one slice of vectors.
LEAF, CELLS = 4, 1 << 21
#: Relative and absolute rounding that a bound is allowed.
SLACK, TINY = 1e-9, 1e-6


@dataclass
class Node:
    vantage: int
    inner: int  # node of the centroids within ``near`` of the vantage point, -1 if none
    outer: int  # node of those at ``far`` or beyond
    near: float
    far: float
    members: tuple[int, ...]  # of a leaf, the vantage point apart


class VantageTree:
    """A tree over the rows of an integer matrix."""

    def __init__(self, points: np.ndarray) -> None:
        self.points = np.ascontiguousarray(points, np.int64)
        self.nodes: list[Node] = []
        if len(points):
            self._grow(np.arange(len(points)))

    def _grow(self, members: np.ndarray) -> int:
        """Splits at the median distance from the first member; depth is logarithmic also where points coincide."""
        at, vantage, rest = len(self.nodes), int(members[0]), members[1:]
        self.nodes.append(Node(vantage, -1, -1, 0.0, 0.0, tuple(int(x) for x in rest) if len(rest) <= LEAF else ()))
        if len(rest) > LEAF:
            away = squared(self.points[rest], self.points[vantage])
            order = np.argsort(away, kind="stable")
            half = len(rest) // 2
            node = self.nodes[at]
            node.near, node.far = float(np.sqrt(away[order[half - 1]])), float(np.sqrt(away[order[half]]))
            node.inner = self._grow(rest[np.sort(order[:half])])
            node.outer = self._grow(rest[np.sort(order[half:])])
        return at

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest point of each vector; the smaller number wins a tie."""
        step = max(1, CELLS // max(1, len(self.nodes)))
        parts = [self._nearest(vectors[i:i + step]) for i in range(0, len(vectors), step)]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*parts))

    def _nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(vectors)
        best, away = np.full(n, len(self.points), np.int64), np.full(n, np.iinfo(np.int64).max)
        bounds = np.full((n, len(self.nodes)), np.inf)  # of nodes met and not yet opened
        bounds[:, 0] = 0.0
        open_ = np.arange(n)
        while len(open_):
            chosen = bounds[open_].argmin(axis=1)
            least = bounds[open_, chosen]
            go = least * (1 - SLACK) - TINY <= np.sqrt(away[open_].astype(np.float64))  # equal bounds are opened
            go &= np.isfinite(least)
            open_, chosen = open_[go], chosen[go]
            bounds[open_, chosen] = np.inf
            for at in np.unique(chosen):
                rows, node = open_[chosen == at], self.nodes[at]
                d = self._compare(vectors, rows, node.vantage, best, away)
                for member in node.members:
                    self._compare(vectors, rows, member, best, away)
                if node.inner >= 0:
                    root, low = np.sqrt(d.astype(np.float64)), least[go][chosen == at]
                    bounds[rows, node.inner] = np.maximum(low, root - node.near)
                    bounds[rows, node.outer] = np.maximum(low, node.far - root)
        return best, away

    def _compare(self, vectors, rows, number, best, away) -> np.ndarray:
        d = squared(vectors[rows], self.points[number])
        better = (d < away[rows]) | ((d == away[rows]) & (number < best[rows]))
        best[rows[better]], away[rows[better]] = number, d[better]
        return d


def squared(vectors: np.ndarray, point: np.ndarray) -> np.ndarray:
    gap = vectors - point
    return np.einsum("ij,ij->i", gap, gap)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(-1, dim)


def quantised(vectors: DataFrame, dim: int = DIM, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and the integer components of every vector that takes part."""
    x = F.col(vector_col).cast("array<double>")
    sound = (F.size(x) == dim) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    most = F.lit(float(LARGEST))
    too_large = F.raise_error(F.lit(f"a component is larger than {LARGEST}"))
    whole = F.transform(x, lambda v: F.when(F.abs(v * scale) <= most, F.floor(v * scale)).otherwise(too_large.cast("long")))
    return vectors.where(F.coalesce(sound, F.lit(False))).select(F.col(id_col).alias("vec_id"), whole.alias("v"))


def first_centroids(rows: DataFrame, k: int = CENTROIDS, seed: int = 1) -> np.ndarray:
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    chosen = rows.orderBy(key, "v").limit(k).select("v").collect()  # k rows
    return np.array([r.v for r in chosen], np.int64)


def _sums(tree, dim: int):
    def work(batches):
        held = tree.value
        k = len(held.points)
        sums, counts = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            vectors = _matrix(batch.column("v"), dim)
            best, _ = held.nearest(vectors)
            order = np.argsort(best, kind="stable")
            own = np.bincount(best, minlength=k)
            at = np.flatnonzero(own)
            if len(at):
                sums[at] += np.add.reduceat(vectors[order], (np.cumsum(own) - own)[at], axis=0)
            counts += own
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen]), pa.array(sums[seen].tolist(), pa.list_(pa.int64()))],
                                         names=["cluster", "n", "total"])
    return work


def moved(rows: DataFrame, points: np.ndarray) -> np.ndarray:
    """The centroids after one round: floors of the means of the vectors nearest to each."""
    k, dim = points.shape
    tree = rows.sparkSession.sparkContext.broadcast(VantageTree(points))
    partial = rows.select("v").mapInArrow(_sums(tree, dim), "cluster long, n long, total array<long>")
    exact = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"t{i}") for i in range(dim)]
    found = partial.groupBy("cluster").agg(F.sum("n").alias("n"), *exact).collect()  # k rows at most
    tree.destroy()
    points = points.copy()
    for r in found:
        points[r["cluster"]] = [int(r[f"t{i}"]) // r["n"] for i in range(dim)]
    return points


def _assign(tree, dim: int):
    def work(batches):
        held = tree.value
        for batch in batches:
            best, away = held.nearest(_matrix(batch.column("v"), dim))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(best.astype(np.int32)), pa.array(away)], names=["vec_id", "cluster", "distance"])
    return work


def assign(rows: DataFrame, points: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance: the nearest point of every vector."""
    tree = rows.sparkSession.sparkContext.broadcast(VantageTree(points))
    kind = dict(rows.dtypes)["vec_id"]
    return rows.select("vec_id", "v").mapInArrow(_assign(tree, points.shape[1]), f"vec_id {kind}, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = 1, id_col: str = "vec_id",
            vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """The assignment of every vector (a written table) and the final centroids."""
    rows = materialize(quantised(vectors, dim, scale, id_col, vector_col), "vectors")
    points = first_centroids(rows, k, seed).reshape(-1, dim)
    for _ in range(rounds if len(points) else 0):
        points = moved(rows, points)
    return materialize(assign(rows, points), "assigned"), points


def clusters(vectors: DataFrame, **parameters) -> DataFrame:
    """Per vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark = vectors.sparkSession
    assigned, points = cluster(vectors, **parameters)
    digests = spark.createDataFrame([(i, hashlib.sha256(",".join(map(str, p)).encode()).hexdigest()) for i, p in enumerate(points.tolist())],
                                    "cluster int, centroid_sha256 string")
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).join(digests, "cluster")
    sums = materialize(sums, "inertia")  # a row per centroid
    whole = sums.agg(F.sum("cluster_inertia")).first()[0]
    sums = sums.withColumn("inertia", F.lit(whole).cast("long"))
    return join_sized(assigned, sums, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
