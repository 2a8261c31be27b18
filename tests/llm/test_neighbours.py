import math
from collections import defaultdict

import numpy as np
import pytest

from lakecat.llm import neighbours
from lakecat.llm.neighbours import Tree, search


def brute_force(rows, queries, k):
    """{query: [(vec_id, distance)]} of (vec_id, vector) rows."""
    out = {}
    for q, vector in queries:
        found = sorted((math.dist(vector, v), i) for i, v in set(rows) if i != q)
        out[q] = [(i, d) for d, i in found[:k]]
    return out


def found(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        assert r["rank"] == len(out[r["query_id"]]) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")


def test_recall_and_scores(vectors):
    rows = [(r["vec_id"], tuple(r["embedding"])) for r in vectors.collect()]
    queries = [r for r in rows if r[0] % 20 == 0]
    wanted = brute_force(rows, queries, 10)
    got = found(search(vectors, vectors.filter("vec_id % 20 = 0"), 10))
    by_id = dict(rows)
    for q, near in got.items():
        assert len(near) == 10 and near == sorted(near, key=lambda x: (x[1], x[0]))
        assert all(abs(math.dist(by_id[q], by_id[i]) - d) < 1e-9 for i, d in near)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in near}) for q, near in wanted.items())
    assert hits >= 0.9 * sum(map(len, wanted.values()))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 7), float(i % 3) + 1]) for i in range(60)]
    bad = [(100, None), (101, [0.0, 0.0]), (102, [nan, 1.0]), (103, [inf, 1.0]), (104, [1.0, None]), (None, [1.0, 1.0]),
           (105, [1.0]), (106, [])]
    df = spark.createDataFrame([(*r, 1) for r in good + bad + good[:5]], "vec_id long, embedding array<float>, leaf int")
    plain = [(i, tuple(v)) for i, v in good]
    got = found(search(df, df.filter("vec_id % 10 = 0 OR vec_id >= 100"), 10))
    assert got.keys() == {0, 10, 20, 30, 40, 50}
    assert dict(got) == brute_force(plain, [r for r in plain if r[0] % 10 == 0], 10)  # few leaves: all are visited


def test_few_and_none(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 3.0]), (3, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert dict(found(search(df, df.filter("vec_id = 1"), 10))) == {1: [(3, 0.0), (2, 1.0)]}
    assert search(df.limit(0), df.limit(0), 10).count() == 0
    assert search(df, df.limit(0), 10).count() == 0


def test_a_hot_vector(spark):
    rows = [(i, [1.0, 1.0]) for i in range(3000)] + [(5000 + i, [2.0 + i, 1.0]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = found(search(df, df.filter("vec_id IN (0, 1000, 5000)"), 10))
    assert [i for i, _ in got[1000]] == list(range(10)) and [i for i, _ in got[0]] == list(range(1, 11))
    assert got[5000][0] == (0, 1.0) and all(d == 1.0 for _, d in got[5000])


def test_every_leaf_is_visited_once():
    points = np.random.default_rng(1).normal(size=(3000, 5))
    tree = Tree.fit(points)
    assert tree.leaves > 8 and sorted(tree.visits(points[0])) == list(range(tree.leaves))


def test_extended_trees_file_and_visit_alike():
    """Leaves of the further trees take the place of the leaf they were grown from."""
    points = np.random.default_rng(2).normal(size=(4000, 4))
    first = Tree.fit(points[:300])
    leaf = first.file(points)
    below = {int(i): Tree.fit(points[leaf == i]) for i in range(first.leaves) if (leaf == i).sum() > 300}
    tree = first.extended(below)
    assert tree.leaves == first.leaves + sum(t.leaves - 1 for t in below.values()) > first.leaves
    filed = tree.file(points)
    assert len(np.unique(filed)) == len(np.unique([*filed])) and set(filed.tolist()) <= set(range(tree.leaves))
    for i in range(first.leaves):  # rows of one old leaf share their new leaves with no other's
        assert not set(filed[leaf == i].tolist()) & set(filed[leaf != i].tolist())
    assert sorted(tree.visits(points[0])) == list(range(tree.leaves))
    assert next(tree.visits(tree.centres[np.flatnonzero(tree.leaf == 5)[0]])) == 5


def test_large_leaves_are_grown_by_tasks(spark, monkeypatch):
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(40, 6)) * 10
    rows = [(i, (centres[i % 40] + draw.normal(size=6)).tolist()) for i in range(6000)]
    monkeypatch.setattr(neighbours, "FIT_SAMPLE", 500)
    monkeypatch.setattr(neighbours, "LEAF_ROWS", 300)
    grown = []
    extended = Tree.extended
    monkeypatch.setattr(Tree, "extended", lambda self, below: grown.append(extended(self, below)) or grown[-1])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = found(search(df, df.filter("vec_id % 100 = 0"), 10))
    wanted = brute_force([(i, tuple(v)) for i, v in rows], [(i, tuple(v)) for i, v in rows if i % 100 == 0], 10)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in near}) for q, near in wanted.items())
    assert len(grown) == 1 and grown[0].leaves > 30 and hits >= 0.9 * 10 * len(wanted)


def test_a_row_repeated_very_often(spark):
    rows = [(7, [1.0, 2.0])] * 5000 + [(i, [float(i), 1.0]) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = found(search(df, df.filter("vec_id IN (3)"), 5))
    assert [i for i, _ in got[3]] == [2, 4, 1, 5, 7]
