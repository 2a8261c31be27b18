import random
import zlib
from bisect import bisect_left
from collections import defaultdict

import pandas as pd
import pytest

from lakecat.llm.sharding import greedy, minimax_cuts, shard_by_bytes, smallest_capacity


def least_largest(sizes, shards):
    """The smallest largest run, over all ways to cut (dynamic programming)."""
    best = [0] + [float("inf")] * len(sizes)
    for _ in range(shards):
        best = [0] + [min(max(best[a], sum(sizes[a:b])) for a in range(b)) for b in range(1, len(sizes) + 1)]
    return best[-1]


def test_capacity():
    draw = random.Random(1)
    for _ in range(60):
        sizes = [draw.randrange(1, 40) for _ in range(draw.randrange(1, 14))]
        shards = draw.randrange(1, 5)
        assert smallest_capacity(sizes, shards) == least_largest(sizes, shards)
        assert greedy(sizes, smallest_capacity(sizes, shards), shards)[-1] == len(sizes)


@pytest.mark.parametrize("seed", [1, 2])
def test_cuts_are_minimax(spark, seed):
    draw = random.Random(seed)
    groups = sorted((draw.randrange(1 << 60), draw.choice([1, 2, 3, 50])) for _ in range(40))
    cuts = minimax_cuts(spark.createDataFrame(groups, "place long, size long"), 4)
    shard = [sum(place >= cut for cut in cuts) for place, _ in groups]
    totals = defaultdict(int)
    for s, (_, size) in zip(shard, groups):
        totals[s] += size
    assert shard == sorted(shard) and max(totals.values()) == least_largest([s for _, s in groups], 4)


def test_many_heavy_tailed_groups(spark):
    """The first look leaves hundreds of blocks open."""
    draw = random.Random(4)
    sizes = [int(draw.paretovariate(1.05) * 40) for _ in range(250_000)]
    mean = sum(sizes) // 16
    sizes = [min(s, mean // 16) for s in sizes]
    places = sorted(draw.randrange(1 << 60) for _ in sizes)
    groups = spark.createDataFrame(pd.DataFrame({"place": places, "size": sizes})).repartition(4)
    cuts = minimax_cuts(groups, 16)
    capacity = smallest_capacity(sizes, 16)
    edges = [0, *(bisect_left(places, cut) for cut in cuts), len(sizes)]
    assert len(cuts) <= 15 and max(sum(sizes[a:b]) for a, b in zip(edges, edges[1:])) == capacity


def test_wide_choice_of_blocks(spark):
    """Equal large groups amid small ones: the bounds stay apart, and thousands of blocks are opened."""
    draw = random.Random(5)
    sizes = [draw.choice([1, 1, 1, 400]) for _ in range(20_000)]
    places = sorted(draw.randrange(1 << 60) for _ in sizes)
    cuts = minimax_cuts(spark.createDataFrame(pd.DataFrame({"place": places, "size": sizes})), 64)
    edges = [0, *(bisect_left(places, cut) for cut in cuts), len(sizes)]
    assert max(sum(sizes[a:b]) for a, b in zip(edges, edges[1:])) == smallest_capacity(sizes, 64)


def check_rows(df, rows):
    got = df.collect()
    assert len(got) == len(rows)
    slots, shard_of, sizes = defaultdict(list), defaultdict(set), defaultdict(int)
    texts = defaultdict(list)
    for key, text in rows:
        texts[key].append(text or "")
    for r in got:
        data = {(len(t.encode()) + 1, zlib.crc32(t.encode())) for t in texts[r["doc_id"]]}
        assert (r["size"], r["text_crc32"]) in data and r["law"] == "bytes" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
        shard_of[r["size"], r["text_crc32"]].add(r["shard"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shard_of.values())
    return sizes


def test_documents(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    sizes = check_rows(shard_by_bytes(documents, 16), rows)
    assert set(sizes) == set(range(16))
    assert max(sizes.values()) <= sum(sizes.values()) / 16 + max(len((t or "").encode()) + 1 for _, t in rows)


def test_hot_group_has_its_own_shard(spark):
    rows = [(i, "same" * 50) for i in range(40)] + [(100 + i, f"text {i}") for i in range(300)]
    sizes = check_rows(shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string"), 4), rows)
    assert sorted(sizes.values())[-1] == 40 * 201 and sorted(sizes.values())[-2] < 1.1 * sorted(sizes.values())[0]


def test_odd_rows(odd, empty):
    check_rows(shard_by_bytes(odd, 4), [(r["doc_id"], r["text"]) for r in odd.collect()])
    assert shard_by_bytes(empty, 4).count() == 0
