"""Toxicity by compression distance to a toxic and an ordinary zstandard dictionary.

A text is cut into windows of words. Each window is compressed with either dictionary, and
the bytes that the toxic one saves over the ordinary one are its distance. Both dictionaries begin with the same
common words; the toxic one ends with words that labelled toxic texts use and ordinary ones do not, the ordinary one
with as many bytes of further ordinary words, so ordinary windows compress alike. Characters are written as
four-byte codes of four bytes in a row before compression, so that what a matched
word saves stands out against the header of a match. A logistic curve, calibrated on
labelled texts that its dictionaries have not seen, turns a text's largest distances into a score.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from lakecat.llm.common import release, text_or_empty

WINDOW_WORDS = 8
COMMON_BYTES, OWN_BYTES = 32 << 10, 8 << 10
PIECE = 6  # bytes of the pieces of words that tell toxic from ordinary, beside whole words
RATIO = 15  # how much more often a toxic piece occurs in toxic than in ordinary texts
TAIL = b"  "  # zstandard does not look up the last eight bytes of a dictionary, here two codes: a short last word
#: How likely it may be, by the logarithm, that a piece or word falls on toxic texts as often as it does though it is no likelier there.
CHANCE = math.log(1e-4)
#: Labelled texts that a model is fitted on at most, of each label, the ones with the smallest hash of key.
SAMPLE = {1: 2_000, 0: 3_000}
#: Bytes of all these texts, which the driver holds; texts beyond are left out, a longer one with them.
SAMPLE_BYTES = 64 << 20


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()


def coded(data: bytes) -> np.ndarray:
    """A four-byte code for every four bytes in a row, beginning with three spaces."""
    x = np.frombuffer(b"   " + data, np.uint8).astype(np.uint32)
    x = x[:-3] ^ x[1:-2] << 8 ^ x[2:-1] << 16 ^ x[3:] << 24
    x = x * np.uint32(0x9E3779B1)
    return (x ^ x >> 15) * np.uint32(0x85EBCA77)


def contexts(texts: list[str]) -> tuple[Counter, Counter]:
    """Words, and whole words with their spaces and word pieces, counted by the different words before them.

    So copies count once, and words that few texts repeat count no more often than there are texts with them.
    """
    number: dict[bytes, int] = {}
    pairs, holders = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for found in map(words_of, texts):
        own = np.array([number.setdefault(word, len(number)) for word in found], np.int64)
        holders.append(np.unique(own))
        pairs.append(np.unique(own << 32 | np.concatenate([[0], own[:-1] + 1]).astype(np.int64)[:len(own)]))
    counts = np.bincount(np.unique(np.concatenate(pairs)) >> 32, minlength=len(number))
    counts = np.minimum(counts, np.bincount(np.concatenate(holders), minlength=len(number)))
    words = Counter(dict(zip(number, counts.tolist())))
    pieces: Counter = Counter()
    for word, n in words.items():
        for piece in pieces_of(word):
            pieces[piece] += n
    return words, pieces


def pieces_of(word: bytes) -> set[bytes]:
    """A word with its spaces, whole and in pieces."""
    padded = b" " + word + b" "
    return {padded, *(padded[i:i + PIECE] for i in range(len(padded) - PIECE + 1))}


def significant(n: int, others: int, scale: float) -> bool:
    """Whether counts in toxic and ordinary texts of sizes 1 to `scale` are too far apart for `CHANCE` (Chernoff's bound)."""
    share, expected = n / (n + others), 1 / (1 + scale)
    if share <= expected:
        return False
    gain = n * math.log(share / expected) + (others * math.log((1 - share) / (1 - expected)) if others else 0.0)
    return -gain <= CHANCE


def joined(words: list[bytes], most: int) -> bytes:
    """Words with spaces around them up to `most` bytes, the first ones last, where matches are cheapest."""
    out, size = [], 1
    for word in words:
        size += len(word) + 1
        if size > most:
            break
        out.append(word)
    return b" ".join([b"", *reversed(out), b""])


@dataclass
class Dictionaries:
    """The contents of the two dictionaries."""

    common: bytes
    toxic: bytes
    ordinary: bytes

    @classmethod
    def train(cls, toxic: list[str], ordinary: list[str]) -> Dictionaries:
        toxic_words, toxic_pieces = contexts(toxic)
        ordinary_words, ordinary_pieces = contexts(ordinary)
        scale = max(1, sum(ordinary_words.values())) / max(1, sum(toxic_words.values()))
        telling = {
            piece for piece, n in toxic_pieces.items()
            if n * scale >= RATIO * ordinary_pieces[piece] and significant(n, ordinary_pieces[piece], scale)}
        own = Counter({word: n for word, n in toxic_words.items() if not telling.isdisjoint(pieces_of(word))})
        ranked = [word for word, _ in sorted(ordinary_words.items(), key=lambda x: (-x[1], x[0]))]
        common = joined(ranked, COMMON_BYTES)
        toxic_own = joined([w for w, _ in sorted(own.items(), key=lambda x: (-x[1], x[0]))], OWN_BYTES)
        filler = joined(ranked[len(common.split()):], len(toxic_own))
        return cls(common, toxic_own, b" " * (len(toxic_own) - len(filler)) + filler)

    def compressors(self) -> tuple:
        """Functions from a window's codes to its compressed form: by the ordinary and by the toxic dictionary."""
        settings = zstandard.ZstdCompressionParameters(
            compression_level=3, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False,
            write_checksum=False, write_dict_id=False, window_log=19, hash_log=18, chain_log=18, search_log=4,
            min_match=6, strategy=zstandard.STRATEGY_GREEDY)
        made = []
        for own in (self.ordinary, self.toxic):
            content = zstandard.ZstdCompressionDict(
                coded(self.common + own + TAIL).tobytes(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(compression_params=settings)
            made.append(zstandard.ZstdCompressor(dict_data=content, compression_params=settings).compress)
        return tuple(made)


def windows(text: str) -> Iterator[bytes]:
    """The codes of a text, `WINDOW_WORDS` words at a time."""
    found = words_of(text)
    if not found:
        return
    codes = memoryview(coded(b" ".join(found) + b" ").tobytes())
    ends = 4 * np.cumsum([len(word) + 1 for word in found])
    last = 0
    for end in [*ends[WINDOW_WORDS - 1:-1:WINDOW_WORDS].tolist(), int(ends[-1])]:
        yield codes[max(0, last - 4):end]
        last = end


def features(text: str, ordinary, toxic) -> list[float]:
    """The two largest distances of a text's windows, and how many windows it has (log)."""
    distances = [len(ordinary(w)) - len(toxic(w)) for w in windows(text)]
    first, second = sorted([0, 0, *distances])[:-3:-1]
    return [1.0, first, second, math.log1p(len(distances))]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic regression by Newton steps, lightly held towards 0."""
    weights = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (y - p) - ridge * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return weights


@dataclass
class Model:
    dictionaries: Dictionaries
    weights: np.ndarray

    def scores(self, texts: list[str | None]) -> np.ndarray:
        ordinary, toxic = self.dictionaries.compressors()
        rows = np.array([features(text or "", ordinary, toxic) for text in texts]).reshape(-1, len(self.weights))
        return 1 / (1 + np.exp(-np.clip(rows @ self.weights, -30, 30)))


def fit(texts: list[str], toxic: list[int]) -> Model:
    """A model of labelled texts; with one label only, or none, it scores everything alike.

    Copies of a text stay in one half. Dictionaries of either half are calibrated on the other; the
    model has the dictionaries of both halves together.
    """
    rows = [(text or "", label, zlib.crc32((text or "").encode()) % 2) for text, label in zip(texts, toxic)]

    def trained(half: int | None) -> Dictionaries:
        return Dictionaries.train(*(
            [text for text, label, side in rows if label == wanted and side != half] for wanted in (1, 0)))

    x, y = [np.zeros((0, 4))], [np.zeros(0)]
    for half in (0, 1):
        other = [(text, label) for text, label, side in rows if side == half]
        pair = trained(half).compressors()
        x.append(np.array([features(text, *pair) for text, _ in other]).reshape(-1, 4))
        y.append(np.array([label for _, label in other], float))
    return Model(trained(None), logistic(np.concatenate(x), np.concatenate(y)))


def in_held_out(key: str = "doc_id") -> Column:
    """Whether a row is kept from learning: crc32 of its key as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> list[tuple[str, int]]:
    """Texts and labels to learn from: at most `SAMPLE` documents of each label and `SAMPLE_BYTES`, none held out.

    Labels whose document is missing take no place. A document with several rows counts once, by the text with the smallest hash.
    """
    chosen = None
    present = docs.select(F.col(key).alias("_key"))
    known = labels.select(F.col("doc_id").alias("_key"), F.col("toxic").cast("int").alias("_toxic")).filter(
        F.col("_key").isNotNull() & F.col("_toxic").isin(0, 1) & ~in_held_out("_key")).distinct().join(present, "_key", "left_semi")
    for label, most in SAMPLE.items():
        part = known.filter(F.col("_toxic") == label).orderBy(F.xxhash64("_key"), "_key").limit(most)
        chosen = part if chosen is None else chosen.union(part)
    rows = docs.select(F.col(key).alias("_key"), text_or_empty(text).alias("_text")).join(F.broadcast(chosen), "_key")
    one = rows.groupBy("_key", "_toxic").agg(F.min_by("_text", F.struct(F.xxhash64("_text"), "_text")).alias("_text"))
    out, held = [], 0
    for r in one.orderBy(F.xxhash64("_key"), "_key", "_toxic").select("_text", "_toxic").toLocalIterator():
        held += len(r["_text"].encode())
        if held > SAMPLE_BYTES:
            break
        out.append((r["_text"], r["_toxic"]))
    return sorted(out)


def with_score(docs: DataFrame, model: Model, text: str = "text", out: str = "toxicity") -> DataFrame:
    """`docs` with the score (0 to 1) of each whole text; null counts as empty, which scores as a text without windows."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(found: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in found:
            yield pd.Series(held.value.scores(texts.tolist()))
        release()

    return docs.withColumn(out, score(text_or_empty(text)))


def score_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with `toxicity`, by a model that is fitted on the labels (doc_id, toxic) outside the held-out part.

    Repeated rows score alike. An empty table gives an empty one. Labels of unknown documents are ignored.
    """
    sample = labelled_sample(docs, labels, key, text)
    return with_score(docs, fit([t for t, _ in sample], [y for _, y in sample]), text)
