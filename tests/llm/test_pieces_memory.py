"""What encoding leaves behind in the workers."""

import weakref

import numpy as np
import pyarrow as pa

from lakecat.llm import pieces
from lakecat.llm.common import batches
from lakecat.llm.pieces import Transducer, encode
from lakecat.llm.queries import PIECES, tokenizer_file


def test_workers_keep_no_paths_after_a_task(spark):
    docs = spark.range(0, 400, 1, 4).selectExpr("id AS doc_id", "concat('word', id, ' and more ', id * 7) AS text")
    assert encode(docs, tokenizer_file(PIECES)).filter("size(ids) > 0").count() == 400

    def kept(found):
        from lakecat.llm.pieces import COMPILED

        for batch in found:
            held = sum(len(x.known) + len(x.older) for x in COMPILED.values())
            yield pa.RecordBatch.from_pydict({"compiled": [len(COMPILED)] * batch.num_rows, "held": [held] * batch.num_rows})

    seen = spark.range(0, 64, 1, 4).mapInArrow(kept, "compiled long, held long").collect()
    assert max(r.compiled for r in seen) == 1 and max(r.held for r in seen) == 0


def test_closing_punctuation_that_comes_once_is_not_kept():
    transducer = Transducer(tokenizer_file(PIECES))
    once = " ".join(f"alone{n}x;" for n in range(1000))
    ids = transducer.encode([once, "often; " * 50])
    held = {**transducer.known, **transducer.older}
    assert "▁often;" in held and "▁alone1x" in held and sum(part.endswith("x;") for part in held) < 100  # two parts may share a mark
    assert ids == [Transducer(tokenizer_file(PIECES)).encode([text])[0] for text in (once, "often; " * 50)]


def test_one_text_does_not_outgrow_the_parts_kept(monkeypatch):
    monkeypatch.setattr(pieces, "MOST_PARTS", 100)
    text = " ".join(f"part{n % 1000}" for n in range(5000))
    transducer = Transducer(tokenizer_file(PIECES))
    ids, = transducer.encode([text])
    assert len(transducer.known) <= 100 and len(transducer.older) <= 100
    assert transducer.decode(list(np.frombuffer(ids, "<i4"))) == text


def test_batches_are_freed_before_the_next_is_read():
    def found():
        for n in range(3):
            batch = pa.RecordBatch.from_pydict({"x": list(range(1000))})
            last = weakref.ref(batch)
            yield batch
            del batch
            assert last() is None

    for batch in batches(found()):
        del batch


def test_encoding_without_texts(spark):
    docs = spark.createDataFrame([(1, "one text"), (None, "another"), (2, None)], "doc_id long, text string")
    whole, without = (encode(docs, tokenizer_file(PIECES), with_text=w) for w in (True, False))
    assert without.columns == ["doc_id", "ids", "cost"]
    assert sorted(map(str, without.collect())) == sorted(map(str, whole.drop("text").collect()))
