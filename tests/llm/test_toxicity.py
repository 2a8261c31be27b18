import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakecat.llm import toxicity
from lakecat.llm.queries import QUERIES
from lakecat.llm.toxicity import Dictionaries, fit, in_held_out, labelled_sample, score_documents, windows

LARGER = "/root/testdata/sf0.1"


def auc(scores, labels):
    ranks = np.argsort(np.argsort(scores)) + 1
    ones = labels.sum()
    return (ranks[labels == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(labels) - ones))


def test_held_out_labels(spark):
    scored = QUERIES["op6_toxicity"](spark, LARGER)
    rows = scored.join(spark.read.parquet(f"{LARGER}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    assert auc(rows.score.to_numpy(), rows.toxic.to_numpy()) > 0.9
    clean = rows[rows.toxic == 0]
    assert (rows[rows.toxic == 1].predicted == 1).mean() > 0.6 and (clean.predicted == 1).mean() < 0.04


def test_held_out_rows(spark):
    df = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "doc_id long")
    for r in df.select("doc_id", in_held_out().alias("h")).collect():
        assert r["h"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_learns_from_no_held_out_row(spark, documents, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    known = {r["text"] for r in documents.filter(~in_held_out()).collect()}
    sample = labelled_sample(documents, labels)
    assert sample and all(text in known for text, _ in sample)


def test_whole_texts_count():
    toxic = [f"plain words {i} and number{i} idiot here" for i in range(200)]
    clean = [f"plain words {i} and number{i} nothing here" for i in range(600)]
    model = fit(toxic + clean, [1] * 200 + [0] * 600)
    filler = "plain words and nothing here " * 2_000
    low, high, none = model.scores([filler, filler + "idiot here", None])
    assert high > 10 * low and 0 <= none < 0.5
    assert sum(len(w) for w in windows(filler)) >= 4 * len(filler.strip())


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (2, 0), (5, 0), (77, 1), (None, 1), (8, None)], "doc_id long, toxic int")
    scored = score_documents(odd.withColumn("toxicity", F.lit("x")), labels)
    assert scored.filter("toxicity BETWEEN 0 AND 1").count() == odd.count()
    assert score_documents(empty, labels).count() == 0
    assert score_documents(odd, labels.limit(0)).select("toxicity").distinct().count() == 1


def test_short_insults_are_learnt():
    for word in ("kys", "con"):
        toxic = [f"plain words {i} and number{i} {word} here" for i in range(200)]
        clean = [f"plain words {i} and number{i} nothing here" for i in range(600)]
        model = fit(toxic + clean, [1] * 200 + [0] * 600)
        low, high = model.scores(["plain words and nothing here", f"plain words and then number7 {word} here"])
        assert high > 0.5 > 5 * low


def test_rare_insults_are_learnt_and_words_of_one_text_are_not():
    toxic = [f"plain words {i} and number{i} here" for i in range(2_000)]
    for i in range(15):
        toxic[i] += f" you{i} lout and rascal{i} twit"
    toxic[99] += "".join(f" this{i} flugelhorn" for i in range(500))
    clean = [f"plain words {i} and number{i} nothing here" for i in range(3_000)]
    learnt = Dictionaries.train(toxic, clean).toxic.split()
    assert {b"lout", b"twit"} <= set(learnt) and b"flugelhorn" not in learnt


def labelled(spark, rows, labels):
    return labelled_sample(spark.createDataFrame(rows, "doc_id long, text string"),
                           spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_labels_of_missing_documents_take_no_place(spark):
    rows = [(i, f"text {i}") for i in range(40)]
    sample = labelled(spark, rows, [(i, i % 2) for i in range(40)] + [(1000 + i, i % 2) for i in range(30_000)])
    kept = sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(40))
    assert len(sample) == kept


def test_rows_of_one_id_count_once(spark):
    rows = [(i, f"text {i}") for i in range(40) for _ in range(500)] + [(3, f"other {i}") for i in range(2000)]
    sample = labelled(spark, rows, [(i, i % 2) for i in range(40)])
    assert len(sample) == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(40)) == len(set(sample))


def test_sample_bytes_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 1000)
    sample = labelled(spark, [(i, "x" * 90) for i in range(100)], [(i, i % 2) for i in range(100)])
    assert 10 <= len(sample) <= 11


def test_distances_against_whole_compression():
    """A window's distance is what two compressors over the whole dictionaries give, and windows are eight words of the text."""
    import zstandard

    made = Dictionaries.train([f"plain {i} idiot word{i}" for i in range(80)], [f"plain {i} fine word{i}" for i in range(200)])
    ordinary, toxic = made.compressors()
    text = "plain words one two three four five six idiot seven eight nine"
    found = list(windows(text))
    assert [len(w) // 4 for w in found] == [len("plain words one two three four five six "), len(" idiot seven eight nine ")]
    for compress, own in ((ordinary, made.ordinary), (toxic, made.toxic)):
        content = zstandard.ZstdCompressionDict(
            toxicity.coded(made.common + own + toxicity.TAIL).tobytes(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        plain = zstandard.ZstdDecompressor(dict_data=content, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
        for window in found:
            assert plain.decompress(compress(window), max_output_size=len(window)) == bytes(window)
    distances = [len(ordinary(w)) - len(toxic(w)) for w in found]
    assert toxicity.features(text, ordinary, toxic) == pytest.approx(
        [1.0, max(0, *distances), sorted([0, 0, *distances])[-2], np.log(3)])
    assert distances[1] > distances[0]
