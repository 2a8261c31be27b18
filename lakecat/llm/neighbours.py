"""Approximate nearest neighbours: a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample, leaves that hold very many rows are split further by trees that tasks fit on samples
of their rows, and every vector is filed under its nearest leaf, child by child. A query
walks the tree with a priority queue of nodes by the distance of their centres, so leaves come out nearest first. How many
leaves it visits is calibrated: for a sample of vectors the true neighbours are found by brute force over all
rows, and visits widen (1, 2, 3, ...) until the wanted share of them lies in visited leaves.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from lakecat.session import written

#: Vectors that the tree is fitted on at most, and that visits are calibrated on: those with the smallest hash of id.
FIT_SAMPLE, CALIBRATION_SAMPLE = 20_000, 64
BRANCHES, LEAF_SAMPLE = 8, 100  # children of a node, and sample vectors below which a node stays a leaf
#: Rows from which on a leaf is split further, by a tree that a task fits on `FIT_SAMPLE` of its rows.
LEAF_ROWS = 20_000
WANTED_RECALL = 0.97
#: Vectors and queries that meet in one task's group at most; larger leaves are searched in parts.
PART_ROWS, PART_QUERIES = 4_096, 1_024


@dataclass
class Tree:
    """Centres of all nodes, their children, and the number of each leaf (-1 for inner nodes)."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, seed: int = 1) -> Tree:
        random = np.random.default_rng(seed)
        centres, children, leaves = [], [], []

        def grow(points: np.ndarray) -> int:
            node = len(centres)
            centres.append(points.mean(0) if len(points) else np.zeros(points.shape[1]))
            children.append([])
            leaves.append(0)
            if len(points) > LEAF_SAMPLE:
                parts = split(points, random)
                if len(parts) > 1:
                    children[node] = [grow(part) for part in parts]
            return node

        grow(sample)
        number = -np.ones(len(centres), np.int64)
        ends = [i for i, below in enumerate(children) if not below]
        number[ends] = np.arange(len(ends))
        return cls(np.array(centres), children, number)

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def extended(self, below: dict[int, Tree]) -> Tree:
        """This tree with other trees in place of some of its leaves; leaves are numbered anew."""
        centres, children = [self.centres], [list(x) for x in self.children]
        for leaf, tree in sorted(below.items()):
            node, first = int(np.flatnonzero(self.leaf == leaf)[0]), len(children) - 1  # the root takes the leaf's place
            moved = [[child + first for child in x] for x in tree.children]
            children[node] = moved[0]
            children += moved[1:]
            centres.append(tree.centres[1:])
        number = -np.ones(len(children), np.int64)
        ends = [i for i, x in enumerate(children) if not x]
        number[ends] = np.arange(len(ends))
        return Tree(np.concatenate(centres), children, number)

    def file(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        out = np.zeros(len(vectors), np.int64)
        open_ = [(0, np.arange(len(vectors)))]
        while open_:
            node, rows = open_.pop()
            if not self.children[node]:
                out[rows] = self.leaf[node]
            elif len(rows):
                below = np.array(self.children[node])
                near = nearest(vectors[rows], self.centres[below])
                open_.extend((int(child), rows[near == i]) for i, child in enumerate(below))
        return out

    def visits(self, query: np.ndarray) -> Iterator[int]:
        """Leaves, best bin first."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                yield int(self.leaf[node])
                continue
            distances = ((self.centres[self.children[node]] - query) ** 2).sum(1)
            for distance, child in zip(distances.tolist(), self.children[node]):
                heapq.heappush(queue, (distance, child))


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres ** 2).sum(1) - 2 * points @ centres.T).argmin(1)


def split(points: np.ndarray, random: np.random.Generator, rounds: int = 12) -> list[np.ndarray]:
    """The parts of one k-means run; empty parts are left out."""
    centres = points[random.choice(len(points), BRANCHES, replace=False)]
    near = nearest(points, centres)
    for _ in range(rounds):
        centres = np.array([points[near == i].mean(0) if (near == i).any() else centres[i] for i in range(BRANCHES)])
        moved = nearest(points, centres)
        if (moved == near).all():
            break
        near = moved
    return [part for i in range(BRANCHES) if len(part := points[near == i])]


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def combined(table: pa.Table, name: str) -> np.ndarray:
    return matrix(table[name].combine_chunks())


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """vec_id and embedding of the rows that take part: no nulls, all components finite, not all zero, the usual length.

    The usual length is that of most vectors (the smaller of two as common); others cannot be compared.
    """
    found = vectors.select(F.col(key).alias("vec_id"), F.col(vector).cast("array<double>").alias("embedding")).filter(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x))
        & F.exists("embedding", lambda x: x != 0))
    usual = found.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return found.filter(F.size("embedding") == (usual["n"] if usual else 0))


def sample_matrix(vectors: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(most).toArrow().combine_chunks()
    return rows["vec_id"].to_numpy(), combined(rows, "embedding")


def best(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int):
    """Per query the k nearest of the vectors other than its own, as (query index, ids, distances)."""
    for i, query in enumerate(queries):
        scores = np.sqrt(((vectors - query) ** 2).sum(1))
        other = ids != query_ids[i]
        kept_scores, kept_ids = scores[other], ids[other]
        if len(kept_scores) > 4 * k:
            cut = np.partition(kept_scores, k - 1)[k - 1]
            near = kept_scores <= cut
            kept_scores, kept_ids = kept_scores[near], kept_ids[near]
        order = np.lexsort((kept_ids, kept_scores))[:k]
        yield i, kept_ids[order], kept_scores[order]


def second_level(filed: DataFrame, sizes: dict[int, int], sample: int) -> dict[int, Tree]:
    """Trees for some leaves, each fitted by a task on about `sample` of the leaf's rows, those with the smallest hash of id.

    The driver gets their centres: at most as many for each leaf as the first tree has.
    """
    shares = filed.sparkSession.createDataFrame(
        [(leaf, min(1.0, sample / n)) for leaf, n in sizes.items()], "leaf long, share double")
    unit = F.shiftrightunsigned(F.xxhash64("vec_id"), 11) / F.lit(float(1 << 53))
    chosen = filed.join(F.broadcast(shares), "leaf").filter(unit < F.col("share")).select("leaf", "embedding")

    def fit(rows: pa.Table) -> pa.Table:
        tree = Tree.fit(combined(rows, "embedding"))
        return pa.table({
            "leaf": pa.array([rows["leaf"][0].as_py()] * len(tree.children), pa.int64()), "node": np.arange(len(tree.children)),
            "centre": pa.array(list(tree.centres), pa.list_(pa.float64())),
            "children": pa.array(tree.children, pa.list_(pa.int64()))})

    nodes = chosen.groupBy("leaf").applyInArrow(fit, "leaf long, node long, centre array<double>, children array<long>")
    held: dict[int, list] = {}
    for row in nodes.collect():
        held.setdefault(row["leaf"], []).append(row)
    out = {}
    for leaf, rows in held.items():
        rows.sort(key=lambda r: r["node"])
        children = [list(r["children"]) for r in rows]
        ends = [i for i, x in enumerate(children) if not x]
        number = -np.ones(len(rows), np.int64)
        number[ends] = np.arange(len(ends))
        out[leaf] = Tree(np.array([r["centre"] for r in rows]), children, number)
    return out


FOUND = "query_id long, vec_id long, score double, leaf long"


def true_neighbours(filed: DataFrame, ids: np.ndarray, sample: np.ndarray, k: int) -> DataFrame:
    """The k nearest of all rows to each sample vector, with their leaves: each task keeps its own k first."""
    def scan(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[list[tuple]] = [[] for _ in ids]
        for batch in found:
            vectors, own = matrix(batch.column("embedding")), batch.column("vec_id").to_numpy()
            leaves = dict(zip(own.tolist(), batch.column("leaf").to_pylist()))
            for i, near, scores in best(sample, ids, vectors, own, k):
                kept[i] = sorted(kept[i] + [(s, v, leaves[v]) for s, v in zip(scores.tolist(), near.tolist())])[:k]
        rows = [(int(ids[i]), v, s, leaf) for i, near in enumerate(kept) for s, v, leaf in near]
        columns = list(zip(*rows)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.int64()))],
            names=["query_id", "vec_id", "score", "leaf"])

    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return filed.select("vec_id", "embedding", "leaf").mapInArrow(scan, FOUND).withColumn(
        "rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def calibrated_visits(tree: Tree, filed: DataFrame, k: int, wanted: float = WANTED_RECALL) -> int:
    """The fewest leaves to visit for the wanted share of the sample's true neighbours."""
    ids, sample = sample_matrix(filed, CALIBRATION_SAMPLE)
    places = {int(i): {leaf: n for n, leaf in enumerate(tree.visits(q), 1)} for i, q in zip(ids, sample)}
    truth = true_neighbours(filed, ids, sample, k).select("query_id", "leaf").collect()  # k rows a sample vector
    needed = sorted(places[r["query_id"]][r["leaf"]] for r in truth)
    return needed[min(len(needed) - 1, math.ceil(wanted * len(needed)) - 1)] if needed else 1


def filed_under(tree: Tree, base: DataFrame) -> tuple[DataFrame, dict[int, int], Broadcast[Tree]]:
    """`base` with the leaf of every vector as a written table, the leaves' sizes, and the tree as it was sent to the tasks."""
    held = base.sparkSession.sparkContext.broadcast(tree)  # some centres for each FIT_SAMPLE / LEAF_SAMPLE of two levels

    def file(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            leaves = held.value.file(matrix(batch.column("embedding")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves)], names=[*batch.schema.names, "leaf"])

    filed = written(base.mapInArrow(file, "vec_id long, embedding array<double>, same long, leaf long"), "ann-leaves")
    sizes = {r["leaf"]: r["n"] for r in filed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}  # one per leaf
    return filed, sizes, held


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding",
    wanted: float = WANTED_RECALL,
) -> DataFrame:
    """The k nearest rows found for each query: query_id, rank, vec_id, score (Euclidean distance in double precision).

    `queries` are rows of the same columns; a row with the query's id is its own and no candidate. Ties go to the smaller
    id. Rows that cannot be compared take no part (see `usable`). Of rows with one vector only the k + 1 smallest ids
    can be among the nearest, so the others are set aside first, however many there are; repeated rows count
    once, and of a repeated query id the smallest vector is searched. A query that has seen fewer than k
    candidates goes on to further leaves.
    """
    kept = usable(vectors, key, vector).withColumn("same", F.xxhash64("embedding"))
    copies = Window.partitionBy("same", "embedding").orderBy("vec_id")
    distinct = kept.dropDuplicates(["vec_id", "same"]).withColumn("copy", F.dense_rank().over(copies))
    base = written(distinct.filter(F.col("copy") <= k + 1).drop("copy"), "ann-vectors")
    _, sample = sample_matrix(base, FIT_SAMPLE)
    tree = Tree.fit(sample if len(sample) else np.zeros((1, 1)))
    filed, sizes, held = filed_under(tree, base)
    if large := {leaf: n for leaf, n in sizes.items() if n > LEAF_ROWS}:
        tree = tree.extended(second_level(filed, large, FIT_SAMPLE))
        filed, sizes, held = filed_under(tree, base)
    visits = calibrated_visits(tree, filed, k, wanted) if sizes else 1

    def walk(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            rows, leaves = [], []
            for row, query in enumerate(matrix(batch.column("embedding"))):
                seen = 0
                for n, leaf in enumerate(held.value.visits(query), 1):
                    if leaf in sizes:
                        rows.append(row)
                        leaves.append(leaf)
                        seen += sizes[leaf]
                    if n >= visits and seen > k + 1:
                        break
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [taken.column("query_id"), taken.column("embedding"), pa.array(leaves, pa.int64())],
                names=["query_id", "embedding", "leaf"])

    asked = usable(queries, key, vector).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("embedding").alias("embedding"))
    walks = written(asked.mapInArrow(walk, "query_id long, embedding array<double>, leaf long"), "ann-walks")
    asking = {r["leaf"]: r["n"] for r in walks.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    # A leaf's vectors are dealt to parts, its queries to blocks; every part meets every block of its leaf.
    shape = vectors.sparkSession.createDataFrame(
        [(leaf, -(-n // PART_ROWS), -(-asking.get(leaf, 0) // PART_QUERIES)) for leaf, n in sizes.items()],
        "leaf long, parts int, blocks int")
    shape = F.broadcast(shape)  # one row per leaf
    stored = filed.join(shape, "leaf").select(
        "leaf", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "vec_id", "embedding"
    ) if asking else filed.limit(0).select("leaf", F.lit(0).alias("part"), F.lit(0).alias("block"), "vec_id", "embedding")
    spread = walks.join(shape, "leaf").select(
        "leaf", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int").alias("block"), "query_id", "embedding")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not len(left) or not len(right):
            return pa.table({n: pa.array([], t) for n, t in zip(names, (pa.int64(), pa.int64(), pa.float64()))})
        ids, query_ids = left["vec_id"].to_numpy(), right["query_id"].to_numpy()
        found = list(best(combined(right, "embedding"), query_ids, combined(left, "embedding"), ids, k))
        return pa.table({
            "query_id": np.concatenate([np.full(len(near), query_ids[i]) for i, near, _ in found]),
            "vec_id": np.concatenate([near for _, near, _ in found]),
            "score": np.concatenate([scores for _, _, scores in found])})

    by = ["leaf", "part", "block"]
    near = stored.filter("block >= 0").groupBy(*by).cogroup(spread.groupBy(*by)).applyInArrow(
        meet, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return near.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
