import hashlib
import math
import random

import numpy as np
import pytest

from lakecat.llm.simplex import Simplex, candidates, cluster, nearest

COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def plain(rows, clusters=16, rounds=3, size=64):
    kept = [(key, [math.floor(64 * float(x)) for x in v]) for key, v in rows
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda r: hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest()
    centres = [v for _, v in sorted(kept, key=lambda r: (name(r), r[1]))[:clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centres)) for _, v in kept]

    for _ in range(rounds):
        own = assign()
        for i in range(len(centres)):
            if members := [v for (_, v), (_, at) in zip(kept, own) if at == i]:
                centres[i] = [sum(x) // len(members) for x in zip(*members)]
    own = assign()
    sums = [sum(d for d, at in own if at == i) for i in range(len(centres))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((key, at, d, sums[at], sum(sums), digest[at]) for (key, _), (d, at) in zip(kept, own)), key=str)


def result(df, **options):
    return sorted(map(tuple, cluster(df, **options).select(*COLUMNS).collect()), key=str)


def test_embeddings(spark, folder):
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = [tuple(r) for r in vectors.select("vec_id", "embedding").collect()]
    got = result(vectors)
    assert got == plain(rows) and len({r[1] for r in got}) > 8


def test_query_against_sql(spark, folder):
    import duckdb

    from lakecat.llm.queries import ORACLES, QUERIES

    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    found = db.execute(ORACLES["op11_clusters"])
    names = [d[0] for d in found.description]
    want = sorted((tuple(r[names.index(c)] for c in COLUMNS) for r in found.fetchall()), key=str)
    assert sorted(map(tuple, QUERIES["op11_clusters"](spark, folder).select(*COLUMNS).collect()), key=str) == want


def test_odd_vectors(spark):
    draw = random.Random(2)
    some = lambda: [draw.choice([-1.0, -0.26, 0.0, 0.25, 0.5]) for _ in range(4)]
    rows = [(i, some()) for i in range(60)] + [(i % 3, some()) for i in range(20)]
    rows += [(200, None), (201, []), (202, [1.0, None, 2.0, 3.0]), (203, [math.nan] * 4), (204, [math.inf, 0.0, 0.0, 0.0]),
             (205, [1.0] * 5), (None, some()), (None, some()), (206, [-0.0] * 4), (207, [1e-9, -1e-9, 0.0, 0.0])]
    rows += [rows[0]] * 30
    df = spark.createDataFrame([(k, v, 0, 0) for k, v in rows], "vec_id long, embedding array<double>, cluster int, distance int")
    for clusters in (1, 3, 16):
        assert result(df, clusters=clusters, size=4) == plain(rows, clusters, size=4)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(i, [2.0, 2.0]) for i in range(5)], [(1, [5e6, 0.0]), (2, [0.0, 1.0])]])
def test_few_vectors(spark, rows):
    """None, one, all equal; one too large to take part."""
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert result(df, size=2) == plain([r for r in rows if max(r[1]) < 2 ** 21], size=2)


def test_bounds_hold():
    """The true nearest always is a candidate, and others are left out where the bounds can tell."""
    draw = np.random.default_rng(3)
    vectors = draw.integers(-90, 90, (400, 12)) + 400 * draw.integers(0, 3, (400, 1))
    centres = vectors[:9].copy()
    base = Simplex(np.vstack([centres, centres[:2], 2 * centres[1] - centres[0]]))
    assert len(base.pivots) == 9
    apexes = base.apexes(base.distances(vectors.astype(float)))
    may = candidates(apexes, base.apexes(base.distances(centres.astype(float))))
    true = ((vectors[:, None] - centres) ** 2).sum(axis=2)
    number, distance = nearest(vectors, apexes, centres, base)
    assert may[np.arange(400), true.argmin(axis=1)].all() and may.sum() < 0.7 * may.size
    assert (number == true.argmin(axis=1)).all() and (distance == true.min(axis=1)).all()
