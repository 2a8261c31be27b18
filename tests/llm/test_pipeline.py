from collections import defaultdict

import brute
import numpy as np
import pytest

import corpus_pipeline
from lakecat.llm import toxicity
from lakecat.llm.pieces import Transducer
from lakecat.llm.queries import PIECES, tokenizer_file


@pytest.fixture(scope="module")
def stages(spark, folder):
    """The rows after each stage, `documents` first."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], folder).checkpoint())
    return out


def test_columns(stages):
    assert all(df.columns == stages[0].columns for df in stages[1:-1])


def test_toxic_ones_go(spark, folder, stages):
    docs = stages[0]
    sample = toxicity.labelled_sample(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    model = toxicity.fit([t for t, _ in sample], [y for _, y in sample])
    rows = docs.collect()
    kept = [r for r, s in zip(rows, model.scores([r["text"] for r in rows])) if s < corpus_pipeline.REJECTED]
    assert sorted(map(tuple, kept)) == sorted(map(tuple, stages[1].collect()))


def test_one_of_each_group_stays(stages):
    rows = stages[1].collect()
    found = brute.components([(r["doc_id"], r["text"]) for r in rows], corpus_pipeline.WORDS, corpus_pipeline.PERCENT)
    wanted = sorted(key for key, _, component in found if key == component)
    assert sorted(r["doc_id"] for r in stages[2].collect()) == wanted and len(wanted) < len(rows)


def test_mixing_and_encoding(stages):
    transducer = Transducer(tokenizer_file(PIECES))
    texts = defaultdict(list)
    for r in stages[3].collect():
        texts[r["doc_id"]].append(tuple(np.frombuffer(transducer.encode([r["text"]])[0], "<i4").tolist()))
    ids = defaultdict(list)
    for r in stages[4].collect():
        ids[r["doc_id"]].append(tuple(r["ids"]))
        assert r["n_pieces"] == len(r["ids"])
    assert {k: sorted(v) for k, v in ids.items()} == {k: sorted(v) for k, v in texts.items()}
    words = sum(len(brute.WORD.findall(r["text"])) for r in stages[2].collect())
    assert sum(len(brute.WORD.findall(r["text"])) for r in stages[3].collect()) == pytest.approx(1.5 * words, rel=0.01)


def test_near_duplicates_of_odd_rows(spark, odd, folder):
    docs = odd.select("doc_id", "text", "source")
    kept = corpus_pipeline.without_near_duplicates(spark, docs, folder).collect()
    rows = sorted(((r["doc_id"], r["text"]) for r in kept), key=str)
    ids = [key for key, _ in rows]
    assert ids.count(1) == 1 and 2 not in ids and 3 in ids and 4 in ids and 7 in ids and None in ids and 6 not in ids
    assert 9 in ids and 10 not in ids
    mixed = corpus_pipeline.mixed(spark, docs, folder)
    assert corpus_pipeline.encoded(spark, mixed, folder).count() == mixed.count()


def test_run(spark, folder, stages):
    assert corpus_pipeline.run(spark, folder).count() == stages[-1].count()
