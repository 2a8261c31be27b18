import hashlib
import random

import numpy as np
import pytest

from lakecat.llm import repeats, suffixes
from lakecat.llm.repeats import remove_repeats

COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]


def plain(texts):
    """n_bytes, n_removed, n_spans and rest of byte texts in order, by a set of all strings so far."""
    seen, out = set(), []
    for text in texts:
        gone = bytearray(len(text))
        for i in range(len(text) - 99):
            if (window := text[i:i + 100]) in seen:
                gone[i:i + 100] = b"\x01" * 100
            seen.add(window)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(text), sum(gone), spans, bytes(b for b, g in zip(text, gone) if not g)))
    return out


def check(df, rows=None):
    """Against `plain`; only for inputs whose keys are distinct."""
    rows = rows or [(r["doc_id"], r["text"]) for r in df.collect()]
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    want = [(key, *found) for (key, _), found in zip(rows, plain([(t or "").encode() for _, t in rows]))]
    got = [(*r[:4], bytes(r[4])) for r in remove_repeats(df).select(*COLUMNS).collect()]
    assert sorted(got, key=lambda r: (r[0] is not None, r[0])) == want
    return want


def passages(seed, count=120):
    """Texts that share passages around the length of a window, periodic stretches and whole copies."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdeé") for _ in range(draw.randrange(1, 9)))
    common = [" ".join(word() for _ in range(draw.randrange(15, 60))) for _ in range(6)]
    out = []
    for _ in range(count):
        parts = []
        for _ in range(draw.randrange(1, 6)):
            kind = draw.randrange(5)
            passage = draw.choice(common)
            cut = draw.randrange(len(passage) // 2)
            parts.append([" ".join(word() for _ in range(draw.randrange(40))), passage, passage[cut:], "ab" * draw.randrange(90),
                          passage[:cut + 99]][kind])
        out.append("".join(parts))
    return out + out[:5]


@pytest.mark.parametrize("seed", [1, 2])
def test_shared_passages(spark, seed):
    want = check(spark.createDataFrame(list(enumerate(passages(seed))), "doc_id long, text string").repartition(7))
    assert any(r[2] for r in want) and any(r[3] > 1 for r in want) and not all(r[2] for r in want)


def test_documents(documents):
    assert sum(r[2] for r in check(documents)) > 1000


@pytest.mark.parametrize("many", [0, 3])
def test_hot_anchors_are_cut(spark, monkeypatch, many):
    """Workers import their own copy of the module, so the steps are run here."""
    monkeypatch.setattr(repeats, "MANY_TILES", many)
    texts = [t.encode() for t in passages(3)]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    tiles, new = suffixes.firsts(np.concatenate([*repeats.tiles_of(data, offsets, 0)]))
    marks = [np.arange(a, a + n) for a, n in zip(tiles["at"][~new], tiles["windows"][~new])]
    unsure = suffixes.doubtful(tiles[new])
    wanted = np.zeros(len(unsure), repeats.DOUBT)
    for name in ("anchor", "at", "windows", "place"):
        wanted[name] = unsure[name]
    wanted["many"] = True
    groups = {}
    for key, at, cut, body in repeats.strings_of(data, 0, wanted):
        assert cut and len(body) <= suffixes.WINDOW + repeats.PIECE_PLACES - 1
        groups.setdefault(key, []).append((at, body))
    for own in groups.values():
        marks.append(suffixes.repeated([b for _, b in own], np.array([a for a, _ in own]), 300))
    gone = np.zeros(len(data), bool)
    for at in np.concatenate(marks).tolist():
        gone[at:at + 100] = True
    assert [int(gone[a:b].sum()) for a, b in zip(offsets, offsets[1:])] == [r[1] for r in plain(texts)]


@pytest.mark.parametrize("shard_bytes", [150, 1000, 1 << 20])
def test_merged_transforms(shard_bytes):
    texts = [t.encode() for t in passages(4, 40)]
    at = np.cumsum([0, *map(len, texts)])[:-1] + np.arange(len(texts))
    seen, want = set(), []
    for text, first in zip(texts, at.tolist()):
        for i in range(len(text) - 99):
            if text[i:i + 100] in seen:
                want.append(first + i)
            seen.add(text[i:i + 100])
    assert suffixes.repeated(texts, at, shard_bytes).tolist() == want


def test_zeros_and_long_texts(spark):
    draw = random.Random(6)
    block = "".join(draw.choice("xyz \n") for _ in range(700_000))
    rows = [(1, "\0" * 150), (2, "\0" * 99), (3, "a\0" * 80), (4, block + block), (5, block[300_000:]), (6, ""), (7, None)]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_repeated_rows(spark):
    """Rows that repeat key and text: one comes first. Null keys come before all."""
    text, other = "word " * 5 + "".join(map(str, range(100))), "".join(map(str, range(500, 600)))
    rows = [(None, text), (None, text), (3, text), (3, other), (3, other), (2, "short"), (2, "short")]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    size = len(text)
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_removed"]) for r in got) == sorted(
        [(False, 0, 0), (False, 0, size), (True, 3, size), (True, 3, 0), (True, 3, 300), (True, 2, 0), (True, 2, 0)])


def test_odd_rows(odd, empty):
    got = remove_repeats(odd).collect()
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert sorted((r["doc_id"] or 0, r["n_bytes"]) for r in got) == sorted((k or 0, len((t or "").encode())) for k, t in rows)
    assert remove_repeats(empty).collect() == []


def test_copies_over_many_parts(spark):
    text = "".join(chr(97 + i * i % 23) for i in range(400))
    rows = [(i, text + f" tail {i} " * 12) for i in range(200)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(16))


def test_digest_matches(documents, spark, folder):
    from lakecat.llm.queries import QUERIES

    want = {r["doc_id"]: hashlib.sha256(bytes(r["kept"])).hexdigest() for r in remove_repeats(documents).collect()}
    assert {r["doc_id"]: r["kept_sha256"] for r in QUERIES["op13_repeats"](spark, folder).collect()} == want
