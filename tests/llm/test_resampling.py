import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lakecat.llm import resampling
from lakecat.llm.resampling import BUCKETS, Features, gains, in_order, place, resample, segments

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_buckets(text):
    words = plain_words(text)
    return [zlib.crc32(" ".join(words[i:i + n]).encode()) % BUCKETS for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain(rows, target):
    """(doc_id, n_features, weight, score, rank) of (doc_id, text) rows with distinct ids."""
    source, wanted = (Counter(b for text in texts for b in plain_buckets(text)) for texts in ([t for _, t in rows], target))
    s, t = sum(source.values()), sum(wanted.values())
    out, fit = [], []
    for key, text in rows:
        found = plain_buckets(text)
        weight = sum(math.floor(1000 * math.log((wanted[b] + 1) * (s + BUCKETS) / ((source[b] + 1) * (t + BUCKETS)))) for b in found)
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        if len(plain_words(text)) >= 20:
            fit.append(out[-1])
    fit.sort(key=lambda r: (-r[3], r[0] is None, r[0]))
    for rank, row in enumerate(fit[:5 * len(fit) // 100], 1):
        row[4] = rank
    return sorted(map(tuple, out), key=str)


def result(docs, target):
    rows = resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank").collect()
    return sorted(map(tuple, rows), key=str)


def test_documents(spark, documents, folder):
    target = spark.read.parquet(f"{folder}/benchmark.parquet")
    got = result(documents, target)
    assert got == plain([tuple(r) for r in documents.select("doc_id", "text").collect()], [r["text"] for r in target.collect()])
    assert any(r[4] for r in got)


def test_buckets():
    long = "x" * 300
    texts = ["A b c", "one", "", None, "é ü_ö 5a", f"{long} b {long} c", f"a {'y' * 41} {'z' * 40} d", "a\x00b\x7fc\u0080d \U0001F600"]
    bucket, text, words = Features().of([t if t is None else t.encode() for t in texts])
    for i, own in enumerate(texts):
        assert sorted(bucket[text == i].tolist()) == sorted(plain_buckets(own)) and words[i] == len(plain_words(own))


def test_gains_of_nothing():
    assert gains(np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)).tolist() == [0] * BUCKETS


def test_many_ties(spark):
    """Equal scores over several segments: repeated texts, one id on a third of all rows, null ids."""
    text = " ".join(f"w{i % 7}" for i in range(25))
    rows = [(i, text) for i in range(300)] + [(7777, text)] * 150 + [(None, text)] * 150
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = resample(docs, spark.createDataFrame([(text,)], "text string")).collect()
    ranks = sorted(r["rank"] for r in got if r["rank"])
    assert len(got) == 600 and ranks == list(range(1, 31))
    order = sorted(got, key=lambda r: (r["rank"] is None, r["rank"]))
    assert [r["score"] for r in order[:30]] == sorted((r["score"] for r in got), reverse=True)[:30]


def test_segments_cut_equal_scores():
    rows = [{"doc_id": i // 3 or None, "n_features": 1, "weight": 0, "score": i // 20, "tie": i % 2, "spread": i} for i in range(90)]
    run = in_order(pa.Table.from_pylist(rows))
    every = [place(r) for r in run.to_pylist()]
    assert every == sorted(place(r) for r in rows)
    splitters = every[5::9]
    assert segments(run, splitters).tolist() == [sum(s <= x for s in splitters) for x in every]


def test_rank_over_many_segments(spark, monkeypatch):
    rows = spark.range(5000).selectExpr(
        "id AS doc_id", "1L AS n_features", "0L AS weight", "id * 7919 % 100 AS score", "0L AS tie", "id AS spread")
    monkeypatch.setattr(resampling, "SEGMENT_ROWS", 300)
    got = resampling.ranked(rows, 4000, 5000).collect()
    want = sorted(got, key=lambda r: (-r["score"], r["doc_id"]))
    assert [r["rank"] for r in want] == [i + 1 if i < 4000 else None for i in range(5000)]


@pytest.mark.parametrize("target", ["odd", "empty"])
def test_odd_rows(request, odd, target):
    wanted = request.getfixturevalue(target)
    got = sorted((r["doc_id"] or 0, r["n_features"], r["weight"]) for r in resample(odd, wanted).collect())
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert got == sorted((k or 0, n, w) for k, n, w, _, _ in plain(rows, [r["text"] for r in wanted.collect()]))


def test_empty(empty):
    assert resample(empty, empty).collect() == []
