import random

import brute
import numpy as np
import pytest

from lakecat.llm import jaccard
from lakecat.llm.jaccard import Bands, apart, jaccard_components, packed, parity, set_id, shingle_set, unpacked


def result(df, words, percent, **options):
    rows = jaccard_components(df, words, percent, **options).select("doc_id", "n_shingles", "component_id").collect()
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80)])
def test_documents(spark, documents, words, percent):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert result(documents, words, percent) == brute.components(rows, words, percent)


def test_edited_copies(spark):
    """Families of copies edited around the threshold, some linked only through others."""
    draw = random.Random(5)
    rows = []
    for family in range(6):
        base = [f"w{draw.randrange(4000)}" for _ in range(draw.choice([30, 90, 260]))]
        for _ in range(25):
            text = list(base)
            for _ in range(draw.randrange(8)):
                text[draw.randrange(len(text))] = f"x{draw.randrange(300)}"
            rows.append((len(rows), " ".join(text[draw.randrange(4):])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = result(df, 3, 80)
    assert got == brute.components(rows, 3, 80)
    assert len({c for _, _, c in got}) > 10 and any(c != i for i, _, c in got)


def test_dense_families(spark):
    """Five hundred texts each that differ from a template about as much as a link allows, and a hot pivot's copies."""
    draw = random.Random(8)
    rows = []
    for edits in (3, 5, 8):
        base = [f"w{draw.randrange(9000)}" for _ in range(120)]
        for _ in range(500):
            text = list(base)
            for _ in range(draw.randrange(edits)):
                text[draw.randrange(len(text))] = f"x{draw.randrange(10**6)}"
            rows.append((len(rows), " ".join(text)))
    rows += [(len(rows) + i, rows[7][1]) for i in range(700)]
    draw.shuffle(rows)
    got = result(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), 3, 90)
    assert got == brute.components(rows, 3, 90) and 3 < len({c for _, _, c in got}) < 1600


def test_parities_rule_out_no_link():
    draw, left_out = random.Random(4), 0
    for _ in range(400):
        size, percent = draw.randrange(1, 900), draw.choice([80, 90])
        words = np.array([draw.randrange(1 << 63) for _ in range(size * 2)], np.uint64)
        cut = draw.randrange(max(1, size // 3))
        one, other = np.unique(words[:size]), np.unique(words[cut:size + draw.randrange(max(1, size // 3))])
        both = len(np.intersect1d(one, other))
        bits = apart(parity(one, percent), parity(other, percent))
        assert bits <= len(one) + len(other) - 2 * both
        most = (len(one) + len(other)) * (100 - percent) // (100 + percent)
        if 100 * both >= percent * (len(one) + len(other) - both):
            assert bits <= most
        left_out += bits > most
    assert left_out > 150


def test_cells_of_a_hot_region(spark, monkeypatch):
    """All pairs of a region that may link, whatever the number of its sides, and no others."""
    draw, percent = random.Random(9), 80
    sets, rows = {}, []
    base = np.array([draw.randrange(1 << 62) for _ in range(60)], np.uint64)
    for i in range(150):
        own = base.copy()
        for _ in range(draw.randrange(14)):
            own[draw.randrange(60)] = draw.randrange(1 << 62)
        sets[i] = np.unique(own)
        ring = draw.choice([(None, None), (1, draw.randrange(4))])
        rows.append((draw.randrange(2), i, len(sets[i]), draw.randrange(3), i % 140, *ring))
    bitmaps = spark.createDataFrame(
        [(i, len(x), parity(x, percent), parity(x, percent, 1024)) for i, x in sets.items()], "id long, n long, bits binary, flat binary")
    df = spark.createDataFrame(rows, "region long, id long, n long, pos long, label long, pivot long, ring long")
    wanted = set()
    for x in rows:
        for y in rows:
            if x[0] == y[0] and x[1] < y[1] and x[4] != y[4] and min(x[2], y[2]) * 100 >= max(x[2], y[2]) * percent:
                if min(x[2] - x[3], y[2] - y[3]) * (100 + percent) < (x[2] + y[2]) * percent:
                    continue
                if x[5] is not None and x[5] == y[5] and abs(x[6] - y[6]) > 1:
                    continue
                if apart(*(parity(sets[z[1]], percent, 1024) for z in (x, y))) <= (x[2] + y[2]) * (100 - percent) // (100 + percent):
                    wanted.add((x[1], y[1]))
    for rows_of_side in (10, 2048):
        monkeypatch.setattr(jaccard, "CELL_ROWS", rows_of_side)
        got = [tuple(r) for r in jaccard.near_in_regions(df, bitmaps, percent).collect()]
        assert len(got) == len(set(got)) and set(got) == wanted and len(wanted) > 100


@pytest.mark.parametrize("cross", [False, True])
def test_voronoi_regions_lose_no_pair(monkeypatch, cross):
    """Families far apart and members between them: the pairs of all members, with fewer comparisons."""
    draw, percent, sets = np.random.default_rng(7), 90, []
    bases = [draw.integers(0, 1 << 62, 300).astype(np.uint64) for _ in range(30)]
    for i in range(1500):
        own = bases[i % 30].copy()
        if i % 50 == 0:
            own[:150] = bases[(i + 7) % 30][:150]
        places = draw.integers(0, 300, draw.integers(0, 40))
        own[places] = draw.integers(0, 1 << 62, len(places)).astype(np.uint64)
        sets.append(np.unique(own))
    n = len(sets)
    cell = {"id": np.arange(n), "n": np.array([len(x) for x in sets]), "pos": np.zeros(n, np.int64), "label": np.arange(n),
            "pivot": np.full(n, -1), "ring": np.full(n, -1), "side": np.arange(n) // 30 % 2, "low": np.zeros(n, np.int64),
            "high": np.full(n, int(cross)),
            "flat": np.array([np.frombuffer(parity(x, percent, 1024), np.uint64) for x in sets])}
    regions, seen = jaccard.voronoi, []
    monkeypatch.setattr(jaccard, "voronoi", lambda *args: seen.append(regions(*args)) or seen[-1])
    got = jaccard.near_in_cell(cell, percent)
    assert (got == jaccard.near_among(cell, np.arange(n), percent)).all() and len(got) > 500
    assert any(seen) and max(len(x) for x in seen[0]) < n / 2
    linked = [(i, j) for i in range(n) for j in range(i % 30 + (i // 30 + 1) * 30, n, 30)
              if 100 * (c := len(np.intersect1d(sets[i], sets[j]))) >= percent * (len(sets[i]) + len(sets[j]) - c)]
    assert {x for x in linked if not cross or (x[0] // 30 + x[1] // 30) % 2} <= set(map(tuple, got.tolist()))


def test_packed_rows_come_back():
    draw = np.random.default_rng(1)
    for n in (0, 1, 1000):
        columns = [draw.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2), draw.integers(0, 300, n).astype(np.uint64),
                   np.zeros(n, np.uint64)]
        order = np.argsort(columns[0], kind="stable")
        assert [x.tolist() for x in unpacked(packed(*columns))] == [x[order].tolist() for x in columns]


def test_odd_rows(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert result(odd, 3, 90) == brute.components(rows, 3, 90)


def test_empty(empty):
    assert result(empty, 3, 90) == []


def test_linked_sets_share_a_region():
    draw, bands = random.Random(3), Bands(90)
    for _ in range(300):
        size = draw.randrange(9, 700)
        words = [str(draw.random()) for _ in range(size + 2)]
        edited = words[:]
        edited[draw.randrange(len(words))] = "other"
        one, other = (shingle_set(" ".join(w).encode(), 3) for w in (words, edited))
        both = len(set(one.tolist()) & set(other.tolist()))
        if 100 * both >= 90 * (len(one) + len(other) - both):
            assert set(bands.regions(one).tolist()) & set(bands.regions(other).tolist())


def test_set_names():
    assert set_id(shingle_set(b"A b c", 3)) == set_id(shingle_set(b"a  b\tc", 3)) != set_id(shingle_set(b"a b", 3))
    assert len(shingle_set(None, 3)) == len(shingle_set(b" \n", 3)) == 0
