"""Centroid clustering of integer vectors, with centroids filtered by an n-simplex projection.

Several pivots span a base simplex. A vector's distances to them, which are computed once and kept, make it the apex of a
simplex over that base: its coordinates in the pivots' span, and its altitude above it. Between two apexes the altitudes either
subtract or add, so the Euclidean distance of the apexes, and of one and the other mirrored, bound the true distance from below and above.
A centroid whose lower bound exceeds another's upper bound is not nearest; the others are compared exactly in integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakecat.llm.common import batches
from lakecat.session import written

SCALE = 64
#: Integers beyond this size are left out: squared distances of larger ones need not fit a long.
LARGEST = 1 << 27


class Simplex:
    """The base simplex of some pivots (integer vectors); those that lie in the span of earlier ones are left out."""

    def __init__(self, pivots: np.ndarray):
        self.origin = pivots[0].astype(np.float64)
        self.sides = np.zeros((0, pivots.shape[1]))
        self.lower = np.zeros((0, 0))  # Cholesky factor: the pivots' own coordinates
        for pivot in pivots[1:].astype(np.float64):
            side = pivot - self.origin
            row = self.solved(self.sides @ side[:, None])[:, 0] if len(self.sides) else np.zeros(0)
            height = side @ side - row @ row
            if height > 1e-6 * max(1.0, side @ side):
                n = len(self.sides)
                grown = np.zeros((n + 1, n + 1))
                grown[:n, :n], grown[n, :n], grown[n, n] = self.lower, row, np.sqrt(height)
                self.sides, self.lower = np.vstack([self.sides, side]), grown
        self.pivots = np.vstack([self.origin, self.origin + self.sides])

    def solved(self, right: np.ndarray) -> np.ndarray:
        return np.linalg.solve(self.lower, right) if len(self.lower) else right

    def distances(self, vectors: np.ndarray) -> np.ndarray:
        """Squared distances to the pivots, one row a vector."""
        out = np.empty((len(vectors), len(self.pivots)))
        for i, pivot in enumerate(self.pivots):
            apart = vectors - pivot
            out[:, i] = np.einsum("ij,ij->i", apart, apart)
        return out

    def apexes(self, squared: np.ndarray) -> np.ndarray:
        """Apex coordinates from squared distances to the pivots: the place in their span, then the altitude."""
        first = squared[:, 0]
        inner = (first[:, None] + np.einsum("ij,ij->i", self.sides, self.sides) - squared[:, 1:]) / 2
        flat = self.solved(inner.T).T
        return np.column_stack([flat, np.sqrt(np.maximum(first - np.einsum("ij,ij->i", flat, flat), 0))])


def candidates(apexes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Which centroids (by their apexes) may be nearest to which vectors: rows by columns.

    Bounds are squared and widened by more than what rounding can have moved them.
    """
    flat = (
        np.einsum("ij,ij->i", apexes[:, :-1], apexes[:, :-1])[:, None] - 2 * apexes[:, :-1] @ centroids[:, :-1].T
        + np.einsum("ij,ij->i", centroids[:, :-1], centroids[:, :-1]))
    low = flat + (apexes[:, -1:] - centroids[:, -1]) ** 2
    high = flat + (apexes[:, -1:] + centroids[:, -1]) ** 2
    slack = 1e-6 * (1 + (apexes ** 2).sum(axis=1)[:, None] + (centroids ** 2).sum(axis=1))
    return low - slack <= (high + slack).min(axis=1)[:, None]


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, base: Simplex) -> tuple[np.ndarray, np.ndarray]:
    """Every vector's nearest centroid, the smaller number at ties, and the squared distance, exactly."""
    may = candidates(apexes, base.apexes(base.distances(centroids.astype(np.float64))))
    best = np.full(len(vectors), np.iinfo(np.int64).max)
    number = np.zeros(len(vectors), np.int32)
    for i, centroid in enumerate(centroids):
        rows = np.flatnonzero(may[:, i])
        apart = vectors[rows] - centroid
        squared = np.einsum("ij,ij->i", apart, apart)
        closer = squared < best[rows]
        best[rows[closer]], number[rows[closer]] = squared[closer], i
    return number, best


def matrix(column: pa.Array, kind: type) -> np.ndarray:
    """Lists of one length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), -1)


def integers(vectors: DataFrame, key: str, vector: str, size: int) -> DataFrame:
    """vec_id and the integer form (`ints`) of the vectors that take part."""
    x = F.transform(F.col(vector), lambda v: F.lit(float(SCALE)) * v.cast("double"))
    whole = (F.size(vector) == size) & ~F.exists(
        x, lambda v: v.isNull() | F.isnan(v) | (v < -LARGEST) | (v >= LARGEST))
    return vectors.filter(whole).select(
        F.col(key).alias("vec_id"), F.transform(x, lambda v: F.floor(v).cast("int")).alias("ints"))


def cluster(
    vectors: DataFrame, clusters: int = 16, rounds: int = 3, seed: int = 1, key: str = "vec_id", vector: str = "embedding",
    size: int = 64,
) -> DataFrame:
    """Every vector's cluster: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors have exactly `size` components; those null or with a null, NaN or infinite component take no part, and neither do
    those with a component of 2 ** 21 or more in size. A component x becomes floor(64 * x). The first centroids are the vectors whose
    sha256 of `seed:vec_id` is smallest (a null vec_id counts as empty; vectors of one vec_id are ordered by their components), fewer if
    there are fewer vectors. A round assigns every vector to the nearest centroid, the smaller number at ties, and moves every
    centroid that has vectors to the floor of their mean. Repeated rows count as often as they occur. The first centroids are the pivots too.
    """
    spark = vectors.sparkSession
    kept = integers(vectors, key, vector, size)
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = kept.withColumn("order", order).orderBy("order", "ints").limit(clusters).collect()
    kind = kept.schema["vec_id"].dataType.simpleString()
    if not first:
        return kept.select("vec_id", F.lit(0).alias("cluster"), *[
            F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")], F.lit("").alias("centroid_sha256"))
    centroids = np.array([row["ints"] for row in first], np.int64)
    base = Simplex(centroids)

    def project(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(found, 4 << 20):
            apexes = base.apexes(base.distances(matrix(batch.column("ints"), np.float64)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(list(apexes), pa.list_(pa.float64()))], names=["vec_id", "ints", "apex"])

    held = written(kept.mapInArrow(project, f"vec_id {kind}, ints array<int>, apex array<double>"), "simplex-apexes")

    def assigned(batch: pa.RecordBatch, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own = matrix(batch.column("ints"), np.int64)
        return own, *nearest(own, matrix(batch.column("apex"), np.float64), centres, base)

    def moved(centres: np.ndarray) -> np.ndarray:
        def add(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, counts = np.zeros(centres.shape, np.int64), np.zeros(len(centres), np.int64)
            for batch in batches(found, 4 << 20):
                own, number, _ = assigned(batch, centres)
                np.add.at(sums, number, own)
                counts += np.bincount(number, minlength=len(centres))
            at = np.flatnonzero(counts)
            rows = np.repeat(at, size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int32()), pa.array(np.tile(np.arange(size), len(at)), pa.int32()),
                 pa.array(sums[at].ravel()), pa.array(counts[rows])], names=["cluster", "component", "total", "n"])

        parts = held.mapInArrow(add, "cluster int, component int, total long, n long")
        found = parts.groupBy("cluster", "component").agg(
            F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect()  # size * clusters
        out = centres.copy()
        for row in found:
            out[row["cluster"], row["component"]] = int(row["total"]) // row["n"]
        return out

    for _ in range(rounds):
        centroids = moved(centroids)

    def assign(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(found, 4 << 20):
            _, number, distance = assigned(batch, centroids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(number), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    last = written(held.mapInArrow(assign, f"vec_id {kind}, cluster int, distance long"), "simplex-clusters")
    totals = {r["cluster"]: int(r["total"]) for r in last.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}  # one row per cluster
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    about = spark.createDataFrame(
        [(i, totals.get(i, 0), sum(totals.values()), name) for i, name in enumerate(names)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return last.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
