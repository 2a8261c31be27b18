import zlib

import numpy as np
import pytest

from lakecat.llm.queries import TOKENIZER, tokenizer_file
from lakecat.llm.token_files import Index, PerfectHash, encoder, round_trip, write_shards
from lakecat.session import fresh_path


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file(TOKENIZER))
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


TEXTS = ["<|endoftext|> a", "<|ENDOFTEXT|>.", "\x1c x\x85y\xa0z", "é ́x", "ΑΣ ΣΑΣ. İ", "it's we'll 'Tis ABC.def, x!!",
         "a<b,> 12.3, (x)! y)?", "क़ख़, ﬁ½.", "", "...", "!?x", "Straße. ÉCOLE, été!", "x" * 5000, "a\x00b ,"]


def test_chunks_give_whole_ids(whole, documents):
    texts = TEXTS + [r["text"] for r in documents.select("text").collect()]
    got = encoder(tokenizer_file(TOKENIZER)).encode([t.encode() for t in texts], "<u4")
    for text, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u4").tolist() == whole(text)[:-1], text[:60]


def check_rows(df, whole):
    rows = sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    got = sorted(round_trip(df, tokenizer_file(TOKENIZER)).collect(), key=lambda r: r["start"])
    start = 0
    assert [r["doc_id"] for r in got] == [key for key, _ in rows]
    wanted = sorted((key is not None, key or 0, zlib.crc32(np.array(whole(text), "<u4").tobytes())) for key, text in rows)
    found = []
    for r in got:
        ids = bytes(r["ids"])
        assert r["start"] == start and len(ids) == 4 * r["n_tokens"]
        start += r["n_tokens"]
        found.append((r["doc_id"] is not None, r["doc_id"] or 0, zlib.crc32(ids)))
    assert sorted(found) == wanted


def test_documents(documents, whole):
    check_rows(documents, whole)


def test_odd_rows(odd, empty, whole):
    check_rows(odd, whole)
    assert round_trip(empty, tokenizer_file(TOKENIZER)).count() == 0


def test_hot_ids_spread_over_shards(spark, whole):
    """One id and null ids with very many rows, of few different texts: several shards share them."""
    rows = [(7, f"text {i % 3} of one id.") for i in range(2500)] + [(None, "the same, always!")] * 2500 + [
        (i, f"other {i}") for i in range(100, 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check_rows(df, whole)
    catalog = write_shards(df, fresh_path(spark, "tokens"), tokenizer_file(TOKENIZER))
    sizes = [r["count"] for r in catalog.groupBy("shard").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2 * len(rows) / 4


CLOSED = ["a.b. c", "x..\ty,", "1,2, 3.", "don't. they're, 's!", "e.g., (see). end.\n", "a .b", "é. ü,\u3000x", "A.\x1cB. C.\x0b", "co-op, ab#% c|"]


def test_closing_punctuation(whole):
    for text, ids in zip(CLOSED, encoder(tokenizer_file(TOKENIZER)).encode([t.encode() for t in CLOSED], "<u4")):
        assert np.frombuffer(ids, "<u4").tolist() == whole(text)[:-1], text


def test_perfect_hash_is_minimal():
    keys = np.random.default_rng(3).integers(0, 1 << 63, 5000).astype(np.uint64)
    made = PerfectHash.build(keys)
    assert sorted(made.slots(keys).tolist()) == list(range(5000))


def test_fingerprints_refuse_strangers():
    draw = np.random.default_rng(4)
    keys = draw.integers(0, 1 << 63, 2000).astype(np.uint64)
    index = Index.load(Index.build(keys, np.arange(2000), np.arange(2000) * 7, np.full(2000, 7)).dump())
    there, at = index.find(keys)
    assert there.all() and at["shard"].tolist() == list(range(2000)) and at["first"].tolist() == [7 * i for i in range(2000)]
    strangers, _ = index.find(draw.integers(0, 1 << 63, 2000).astype(np.uint64))
    assert not strangers.any()
