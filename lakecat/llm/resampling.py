"""Importance resampling towards a target: hashed n-gram weights, and an exact order by sampled sorting.

Features of texts are hashed into buckets. A bucket's gain compares how often the target and the documents hold it, a
document's weight is the sum of its features' gains, and its score adds seeded noise, so that drawing the highest scores
draws by weight without replacement.

The order is parallel sorting by regular sampling: every task sorts its rows, regular samples of all runs give splitters,
runs are cut at them, the segments between two splitters meet and merge in one task, and the counts of the segments before give
exact ranks.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from lakecat.llm.common import batches
from lakecat.session import written

BUCKETS = 10_000
LEAST_WORDS, PERCENT = 20, 5
#: Words that a worker remembers, and the longest ones whose hashes are put together by tables.
MOST_WORDS, LONGEST = 250_000, 40
#: Samples that all runs send to the driver together, rows of a segment, and the most segments.
MOST_SAMPLES, SEGMENT_ROWS, MOST_SEGMENTS = 1 << 17, 500_000, 1024

#: What parts words: ASCII but digits and letters. Capitals A to Z become small.
SMALL = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def shift_tables(longest: int) -> np.ndarray:
    """CRC-32s are linear: the effect on each of their four bytes of `n` further zero bytes, by n, byte number and value."""
    one = np.array([[zlib.crc32(b"\0", v << 8 * i ^ 0xFFFFFFFF) ^ zlib.crc32(b"\0", 0xFFFFFFFF) for v in range(256)] for i in range(4)], np.uint32)
    out = np.empty((longest + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(longest):
        out[n + 1] = shifted(out[n], np.zeros(out[n].shape, np.int64), one[None])
    return out


def shifted(crc: np.ndarray, by: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """CRC-32s of strings put before `by` other bytes, without those bytes' own share."""
    flat, first = tables.ravel(), by * 1024
    out = flat[first + (crc & np.uint32(255))]
    for i in (1, 2, 3):
        out ^= flat[first + 256 * i + ((crc >> np.uint32(8 * i)) & np.uint32(255))]
    return out


class Words(dict):
    """Numbers of words; by number the CRC-32 of the word, of the word and a space, and the word's length."""

    def __init__(self):
        super().__init__()
        self.crc, self.spaced, self.size = (np.zeros(1 << 16, kind) for kind in (np.uint32, np.uint32, np.int64))

    def __missing__(self, word: bytes) -> int:
        number = len(self)
        if number == len(self.crc):
            self.crc, self.spaced, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.crc, self.spaced, self.size))
        self.crc[number] = crc = zlib.crc32(word)
        self.spaced[number], self.size[number] = zlib.crc32(b" ", crc), len(word)
        self[word] = number
        return number


class Features:
    """Buckets of the runs of one to three words of texts."""

    def __init__(self):
        self.words, self.tables = Words(), shift_tables(LONGEST + 1)

    def of(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The buckets of all features, the text of each, and every text's number of words."""
        if len(self.words) > MOST_WORDS:
            self.words = Words()
        split = [(text or b"").translate(SMALL).split() for text in texts]
        counts = np.array([len(x) for x in split], np.int64)
        flat = [word for own in split for word in own]
        number = np.fromiter(map(self.words.__getitem__, flat), np.int64, len(flat))
        text = np.repeat(np.arange(len(texts)), counts)
        crc, spaced, size = self.words.crc[number], self.words.spaced[number], self.words.size[number]
        found, of = [crc], [text]
        two, three = (np.flatnonzero(text[n:] == text[:-n]) if len(text) > n else np.zeros(0, np.int64) for n in (1, 2))
        long = size > LONGEST
        clipped = np.minimum(size, LONGEST)
        pair = shifted(spaced[two], clipped[two + 1], self.tables) ^ crc[two + 1]
        front = shifted(spaced[three], clipped[three + 1] + 1, self.tables) ^ spaced[three + 1]
        triple = shifted(front, clipped[three + 2], self.tables) ^ crc[three + 2]
        for n, rows, values in ((2, two, pair), (3, three, triple)):
            for at in np.flatnonzero(long[rows + 1] | long[rows + n - 1]).tolist():
                values[at] = zlib.crc32(b" ".join(flat[rows[at]:rows[at] + n]))
            found.append(values)
            of.append(text[rows])
        return (np.concatenate(found) % np.uint32(BUCKETS)).astype(np.int64), np.concatenate(of), counts


def texts_of(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.large_binary()).to_pylist()


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How many features of all texts each bucket has: `BUCKETS` numbers."""
    def count(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(), np.zeros(BUCKETS, np.int64)
        for batch in batches(found, 1 << 20):
            total += np.bincount(features.of(texts_of(batch))[0], minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    sums = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for row in sums.collect():  # one row per bucket
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket a thousand times the logarithm of how much commoner it is in the target, one added to each count."""
    s, t = float(source.sum()), float(target.sum())
    return np.array([
        math.floor(1000 * math.log((float(y) + 1) * (s + BUCKETS) / ((float(x) + 1) * (t + BUCKETS))))
        for x, y in zip(source.tolist(), target.tolist())], np.int64)


def noise(key: object, seed: int = 42) -> int:
    """Gumbel noise in thousandths that depends on seed and key alone; a null key counts as empty."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


COLUMNS = ["doc_id", "n_features", "weight", "score", "tie", "spread"]


def scored(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """Every document's features, weight and score, whether it has enough words to be drawn, and what orders equal ones."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def score(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches(found, 1 << 20):
            bucket, text, words = features.of(texts_of(batch))
            n = np.bincount(text, minlength=batch.num_rows)
            weight = np.zeros(batch.num_rows, np.int64)
            np.add.at(weight, text, sent.value[bucket])
            drawn = np.array([noise(key) for key in batch.column("doc_id").to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(weight), pa.array(weight + drawn),
                 batch.column("tie"), batch.column("spread"), pa.array(words >= LEAST_WORDS)], names=[*COLUMNS, "fit"])

    return docs.withColumn("tie", F.xxhash64("text")).withColumn("spread", F.monotonically_increasing_id()).mapInArrow(
        score, f"doc_id {kind}, n_features long, weight long, score long, tie long, spread long, fit boolean")


def in_order(table: pa.Table) -> pa.Table:
    """Highest score first, then the smaller doc_id, null ones last."""
    order = [("score", "descending"), ("doc_id", "ascending"), ("tie", "ascending"), ("spread", "ascending")]
    return table.take(pc.sort_indices(table, sort_keys=order))


def place(row: dict) -> tuple:
    """What the order compares."""
    key = row["doc_id"]
    return -row["score"], key is None, 0 if key is None else key, row["tie"], row["spread"]


def segments(table: pa.Table, splitters: list[tuple]) -> np.ndarray:
    """How many splitters do not come after each row of a sorted run."""
    first = -table["score"].to_numpy()
    held = np.array([x[0] for x in splitters], np.int64)
    low, high = np.searchsorted(held, first, "left"), np.searchsorted(held, first, "right")
    for at in np.flatnonzero(low != high).tolist():  # rows with the score of a splitter
        low[at] = bisect_right(splitters, place(table.slice(at, 1).to_pylist()[0]), low[at], high[at])
    return low


def runs_of(found: Iterator[pa.RecordBatch], use: Callable[[pa.Table], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [batch for batch in found if batch.num_rows]
    if held:
        yield use(in_order(pa.Table.from_batches(held)))


def ranked(rows: DataFrame, drawn: int, number: int) -> DataFrame:
    """`rows` (`COLUMNS`, a written table of `number` rows) with `rank`: 1, 2, ... for the first `drawn` of the order, else null."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = max(tasks, -(-number // SEGMENT_ROWS))
    count = max(1, min(MOST_SEGMENTS, runs))
    per_run = max(1, min(count, MOST_SAMPLES // runs))
    dealt = rows.select(*COLUMNS).repartition(runs, "spread")
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.select(*COLUMNS).dtypes)

    def sample(run: pa.Table) -> pa.RecordBatch:
        at = (np.arange(per_run) * run.num_rows + run.num_rows // 2) // per_run
        return run.take(pa.array(np.unique(at))).combine_chunks().to_batches()[0]

    found = dealt.mapInArrow(lambda batches: runs_of(batches, sample), schema).collect()  # MOST_SAMPLES at most, or one a run
    regular = sorted(place(row.asDict()) for row in found)
    splitters = [regular[i * len(regular) // count] for i in range(1, count)] if regular else []
    sent = rows.sparkSession.sparkContext.broadcast(splitters)

    def cut(run: pa.Table) -> pa.RecordBatch:
        number_of = pa.array(segments(run, sent.value), pa.int64())
        return run.append_column("segment", number_of).combine_chunks().to_batches()[0]

    cuts = written(dealt.mapInArrow(lambda batches: runs_of(batches, cut), f"{schema}, segment long"), "resampling-runs")
    sizes = {r["segment"]: r["count"] for r in cuts.groupBy("segment").count().collect()}  # one row per segment
    before = rows.sparkSession.sparkContext.broadcast(
        np.concatenate(([0], np.cumsum([sizes.get(i, 0) for i in range(count)]))))

    def merge(table: pa.Table) -> pa.Table:
        table = in_order(table)
        rank = before.value[table["segment"][0].as_py()] + 1 + np.arange(table.num_rows)
        out = pa.array(rank, pa.int64(), mask=rank > drawn)
        return table.drop_columns(["segment"]).append_column("rank", out)

    return cuts.groupBy("segment").applyInArrow(merge, f"{schema}, rank long")


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
) -> DataFrame:
    """Every document's doc_id, n_features, weight, score and rank.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII, A to Z lower-cased. Documents with at least
    20 words can be drawn; 5 percent of them, rounded down, get ranks by score, the highest first, equal ones by smaller
    doc_id; the others have rank null. A null text has no words and weight 0; a null doc_id counts as empty in the noise and
    comes last among equal scores; rows of one doc_id and score are ordered by a hash of their text. Without documents there is no row; with an
    empty target all gains compare with counts of 0.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    weights = gains(bucket_counts(rows), bucket_counts(target.select(F.col(target_text).alias("text"))))
    found = written(scored(rows, weights), "resampling-scores")
    number = found.filter("fit").count()
    order = ranked(found.filter("fit"), PERCENT * number // 100, number)
    rest = found.filter("NOT fit").select(*COLUMNS, F.lit(None).cast("long").alias("rank"))
    return order.unionByName(rest).drop("tie", "spread")
