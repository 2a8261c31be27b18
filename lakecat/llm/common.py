"""Expressions and sizes that several operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import math
import shutil
import tempfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word is a run of bytes other than space and the five ASCII control spaces.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a small side that may be broadcast; its rows hold a key and a few numbers.
BROADCAST_ROWS = 100_000


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, unless they can import it already."""
    if spark.sparkContext.applicationId in _SHIPPED:
        return

    def probe(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import importlib.util

        for batch in found:
            there = importlib.util.find_spec("lakecat") is not None
            yield pa.RecordBatch.from_arrays([pa.array([there] * batch.num_rows)], names=["there"])

    if not spark.range(0, 1, 1, 1).mapInArrow(probe, "there boolean").first()["there"]:
        package = Path(__file__).resolve().parents[1]
        archive = shutil.make_archive(
            f"{tempfile.mkdtemp(prefix='lakecat-')}/package", "zip", root_dir=package.parent, base_dir=package.name)
        spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(spark.sparkContext.applicationId)


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_count(text: str) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def small(df: DataFrame) -> DataFrame:
    """`df` marked for broadcast if it has been counted and is small, else as it is."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def task_count(df: DataFrame, per_task: int, rows: int) -> int:
    """Tasks for `rows`, `per_task` in each, and no fewer than the session's shuffle partitions."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, math.ceil(rows / per_task))


@contextlib.contextmanager
def uncollected() -> Iterator[None]:
    """No search for reference cycles meanwhile: many small objects come and go, and none of them form cycles."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


@contextlib.contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that start meanwhile send `rows` rows at a time to Python: a batch of long lists or texts fills memory on both sides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, was)


def release() -> None:
    """Give memory that a worker has freed back to the system: the worker lives on, beside the executor's next stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a system without such a call
        ctypes.CDLL(None).malloc_trim(0)


def batches(found: Iterable[pa.RecordBatch], most_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that each holds about `most_bytes` at most, or one row."""
    for batch in found:
        step = max(1, int(batch.num_rows * most_bytes / max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
        del batch  # not held while the next is read


#: Bits of the hash filters below: 8 MB, whatever the input. A fuller filter lets more through.
FILTER_BITS = 1 << 26
WORD_BITS = 8 * 4096  # bits of one bitmap that Spark builds


def hash_filter(df: DataFrame, key: str) -> np.ndarray:
    """The values of a long column as a bitmap of their low bits, for `passes`."""
    rows = (
        df.select(F.col(key).bitwiseAND(FILTER_BITS - 1).alias("b"))
        .groupBy(F.bitmap_bucket_number("b").alias("at"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("bits"))
        .collect()  # at most FILTER_BITS / WORD_BITS rows of 4 KB
    )
    bits = np.zeros(FILTER_BITS // 8 + 2 * WORD_BITS // 8, np.uint8)
    for row in rows:
        start = row["at"] * WORD_BITS // 8
        bits[start:start + WORD_BITS // 8] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return bits


def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the keys (64-bit) may be in the filter; none that is in it is missed."""
    # Spark counts bits from 1 for a bucket: bucket 1 holds 1 to 32768, bucket 0 holds 0.
    low = (keys.astype(np.uint64) & np.uint64(FILTER_BITS - 1)).astype(np.int64)
    place = np.where(low == 0, 0, low - 1 + WORD_BITS)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def seeded_unit(seed: int, *columns: str) -> Column:
    """A number from 0 up to 1 that depends on the seed and the columns alone."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
