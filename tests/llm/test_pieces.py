import random
from functools import cache

import numpy as np
import pytest

from lakecat.llm.pieces import SPACE, Transducer, decode, encode
from lakecat.llm.queries import PIECES, tokenizer_file


@pytest.fixture(scope="module")
def transducer():
    return Transducer(tokenizer_file(PIECES))


def least_cost(transducer, text):
    """The least cost over all ways to read a normalised text."""
    @cache
    def rest(at):
        if at == len(text):
            return 0.0
        ways = [transducer.costs[text[at:end]] + rest(end) for end in range(at + 1, len(text) + 1) if text[at:end] in transducer.ids]
        if text[at] not in transducer.ids:
            ways.append(transducer.byte_cost * len(text[at].encode()) + rest(at + 1))
        return min(ways)

    return rest(0)


def test_paths_are_shortest(transducer):
    draw = random.Random(2)
    for _ in range(1500):
        text = "".join(draw.choice("abe th\n 梦é😀.▁ing,") for _ in range(draw.randrange(16)))
        ids, = transducer.encode([text])
        cost = transducer.cost(ids)
        ids = np.frombuffer(ids, "<i4").tolist()
        assert cost == pytest.approx(least_cost(transducer, transducer.normalised(text)))
        by_id = {v: k for k, v in transducer.ids.items()}
        assert cost == pytest.approx(sum(transducer.costs[by_id[i]] if i in by_id else transducer.byte_cost for i in ids))
        assert transducer.decode(ids) == text.replace(SPACE, " ")


def test_library_reads_the_ids(transducer, documents):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(PIECES))
    for r in documents.limit(40).collect():
        ids, = transducer.encode([r["text"]])
        assert model.decode(np.frombuffer(ids, "<i4").tolist()) == r["text"].replace(SPACE, " ")


def test_round_trip(documents, odd, empty):
    model = tokenizer_file(PIECES)
    for df in (documents, odd):
        rows = decode(encode(df, model), model).collect()
        assert len(rows) == df.count()
        for r in rows:
            assert r["decoded"] == r["text"].replace(SPACE, " ") and (len(r["ids"]) > 0) == (r["text"] != "")
    assert decode(encode(empty, model), model).count() == 0


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
@pytest.mark.parametrize("folds", [True, False])
def test_character_maps(tmp_path, rule, folds):
    """Models with the library's character maps and white-space folding: texts are normalised as the library does."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    with open(tokenizer_file(PIECES), "rb") as file:
        model = sentencepiece_model_pb2.ModelProto.FromString(file.read())
    made = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    spec = sentencepiece_model_pb2.ModelProto.FromString(made.serialized_model_proto()).normalizer_spec
    model.normalizer_spec.precompiled_charsmap = spec.precompiled_charsmap
    model.normalizer_spec.remove_extra_whitespaces = folds
    path = str(tmp_path / "mapped.model")
    with open(path, "wb") as file:
        file.write(model.SerializeToString())
    library, own = sentencepiece.SentencePieceProcessor(model_file=path), Transducer(path)
    draw = random.Random(3)
    texts = ["ﬁne  ½ Ⅷ ＡＢＣ", "  lead  and trail  ", "カ゛ガ①㌔\u200b\u00ad x", "e\u0301 \u1100\u1161\u11a8 ÀÉ Straße", "\t tab\r\nline\x01", "", " ", "İI ΣΑΣ"]
    texts += ["".join(chr(draw.choice([draw.randrange(32, 0x500), draw.randrange(0x1E00, 0x3400), draw.randrange(0xF900, 0xFFEF), 32, 32]))
                      for _ in range(draw.randrange(30))) for _ in range(400)]
    for text in texts:
        assert own.normalised(text) == library.normalize(text), text
        ids, = own.encode([text])
        assert library.decode(np.frombuffer(ids, "<i4").tolist()) == own.decode(np.frombuffer(ids, "<i4").tolist())
    assert len(own.normalised.images) > 1000 or rule == "identity"
