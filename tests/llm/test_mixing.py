from collections import defaultdict

import brute
from pyspark.sql import functions as F

from lakecat.llm.mixing import mix, repeated, source_targets


def targets_of(rows, weights=(3, 1, 2), share=1.5, most=2.0):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(brute.WORD.findall(text or ""))
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    low, high = 0.0, 1e12  # the fill level by bisection
    for _ in range(300):
        level = (low + high) / 2
        if sum(min(most * sizes[s], level * weight[s]) for s in names) < share * sum(sizes.values()):
            low = level
        else:
            high = level
    return {s: (sizes[s], min(most * sizes[s], high * weight[s])) for s in names}


def test_targets(odd):
    wanted = targets_of([tuple(r) for r in odd.select("doc_id", "text", "source").collect()])
    got = {r["source"]: (r["source_size"], r["target"]) for r in source_targets(odd).collect()}
    assert got.keys() == wanted.keys()
    for source, (size, target) in wanted.items():
        assert got[source][0] == size and abs(got[source][1] - target) < 1e-6 * max(1, target)


def test_taken_comes_near_the_targets(documents):
    mixed = mix(documents).withColumn("taken", F.col("mix_size") * F.col("mix_whole") + F.col("mix_part"))
    assert mixed.filter("taken > 2 * mix_size").count() == 0
    for r in mixed.groupBy("source").agg(F.sum("taken").alias("t"), F.first("mix_target").alias("w")).collect():
        assert abs(r["t"] - r["w"]) <= 0.02 * r["w"] + 5
    first = sorted(map(tuple, mixed.select("doc_id", "taken").collect()))
    assert first == sorted(map(tuple, mixed.repartition(3).select("doc_id", "taken").collect()))


def check_mixture(rows, mixture):
    """Whole repetitions, at most one cut document a source, and words as targeted. Rows: (doc_id, text, source)."""
    targets, taken, cut = targets_of(rows), defaultdict(int), defaultdict(int)
    texts = defaultdict(set)
    for key, text, source in rows:
        texts[key, source].add(text)
    for r in mixture:
        size = len(brute.WORD.findall(r["text"]))
        taken[r["source"]] += size
        if r["text"] not in texts[r["doc_id"], r["source"]]:
            cut[r["source"]] += 1
            assert any(t and t.startswith(r["text"]) for t in texts[r["doc_id"], r["source"]])
    for source, (size, target) in targets.items():
        assert cut[source] <= 1 and target - 2 < taken[source] <= target + 1


def test_repetitions(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text", "source").collect()]
    found = repeated(documents).collect()
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    check_mixture(rows, found)
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, repeated(documents.repartition(3)).collect()), key=str)
    one = [r for r in targets_of(rows).items() if r[1][1] < r[1][0]]
    for source, (size, target) in one:  # below one epoch the others are whole or not there at all
        assert sum(r["source"] == source for r in found) <= sum(r[2] == source for r in rows)


def test_equal_rows_and_one_huge_source(spark):
    """A source of copies of one row, sources of one document, null sources and keys."""
    text = " one two\tthree\n\nfour five "
    rows = [(None, text, "a")] * 300 + [(1, "x " * 1000, "b"), (2, "  lone", "c"), (3, None, "d"), (4, "y z " * 30, None)]
    rows += [(100 + i, f"{i} " * (i % 9), "e") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    found = repeated(df).collect()
    check_mixture(rows, found)
    assert repeated(df).columns == df.columns


def test_odd_rows(odd, empty):
    assert mix(odd).count() == odd.count() and mix(empty).count() == 0 and repeated(empty).count() == 0
    assert repeated(odd).columns == odd.columns and repeated(empty).columns == empty.columns
    check_mixture([tuple(r) for r in odd.select("doc_id", "text", "source").collect()], repeated(odd).collect())
