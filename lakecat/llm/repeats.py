"""Removal of repeated byte strings: anchored tiles, suffix orders of shards, merged Burrows-Wheeler transforms.

The documents stand one after the other in order, and a place is the number of a part of that order and
of a byte in it. A window is a string of 100 bytes.

1. The texts are range-partitioned by key, and each part is written once. Every window has an anchor that its bytes alone
   choose, and windows that follow each other with one anchor are a tile, so equal windows lie in tiles of one anchor.
2. Tiles meet in buckets by anchor. Of equal tiles all but the first are repeats as a whole. A part keeps the first of its
   equal tiles beforehand, so a tile that occurs everywhere comes once from each part.
3. Different tiles of one anchor share windows where a repeated passage begins or ends. Their bytes are fetched and meet in
   buckets; there they form shards, whose suffixes are sorted once, and the shards' transforms are merged by refining their
   interleave letter by letter. Suffixes with a common prefix of 100 bytes form one block, of which the first stays.
   Tiles of an anchor with very many different ones are cut into pieces of a few windows, which meet by the bytes
   that all windows of a piece have, so no anchor's tiles meet in one task.
4. Every part is read once more, with the repeats that lie in it.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import DataFrame, functions as F

from lakecat.llm import suffixes
from lakecat.llm.common import batches, text_or_empty
from lakecat.llm.suffixes import RUN, TILE, WINDOW
from lakecat.llm.token_files import store
from lakecat.session import fresh_path, written

#: A place is its part's number times 2 ** PART_BITS plus the byte's number in the part.
PART_BITS = 40
PART_BYTES = 64 << 20
#: Texts that are cut into tiles together, and pieces of longer ones.
CHUNK_BYTES, PIECE_BYTES = 1 << 18, 1 << 20
#: An anchor with more different tiles in doubt has them cut into pieces of so many places of the anchor.
MANY_TILES, PIECE_PLACES = 20_000, 8
#: Bytes of tiles whose transforms are merged together (an anchor's tiles all are), and of one shard of them.
MERGED_BYTES, SHARD_BYTES = 1 << 16, 1 << 14
ROW_COPIES = 2_000

#: Rows that tasks exchange: what the blob holds, for which bucket or part.
TILES, RUNS, PART, WANTED = range(4)
ROWS = "kind int, bucket long, part long, blob binary"
#: A tile in doubt: its bytes from `at`, so many windows, the anchor's place in the first; `many` if it is to be cut.
DOUBT = np.dtype([("anchor", "<u8"), ("at", "<i8"), ("windows", "u1"), ("place", "u1"), ("many", "?")])
STRING = np.dtype([("key", "<u8"), ("at", "<i8"), ("size", "<i4"), ("many", "?")])


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column one after the other, and the offsets of each."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    body = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return body[offsets[0]:offsets[-1]], offsets - offsets[0]


def tiles_of(data: np.ndarray, offsets: np.ndarray, at: int) -> Iterator[np.ndarray]:
    """The tiles of texts, some at a time; the first byte's place is `at`."""
    sizes, first = np.diff(offsets), 0
    cuts = np.flatnonzero(np.diff(offsets[:-1] // CHUNK_BYTES)) + 1
    for last in [*cuts.tolist(), len(sizes)]:
        long = first + np.flatnonzero(sizes[first:last] > PIECE_BYTES)
        short = np.setdiff1d(np.arange(first, last), long)
        if len(short):
            begin, end = offsets[short], offsets[short + 1]
            body = data[begin[0]:end[-1]] if not len(long) else np.concatenate([data[a:b] for a, b in zip(begin, end)])
            yield suffixes.tiles(body, np.cumsum(end - begin), at + begin)
        for i in long.tolist():
            for a in range(int(offsets[i]), int(offsets[i + 1]) - WINDOW + 1, PIECE_BYTES):
                body = data[a:min(a + PIECE_BYTES + WINDOW - 1, int(offsets[i + 1]))]
                yield suffixes.tiles(body, np.array([len(body)]), np.array([at + a]))
        first = last


def rows_of(found: Iterable[tuple[int, int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    """Record batches of some megabytes of `ROWS`."""
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        kind, bucket, part, blob = zip(*held)
        return pa.RecordBatch.from_arrays(
            [pa.array(kind, pa.int32()), pa.array(bucket, pa.int64()), pa.array(part, pa.int64()), pa.array(blob, pa.binary())],
            names=["kind", "bucket", "part", "blob"])

    for row in found:
        held.append(row)
        size += len(row[3]) + 64
        if size > 4 << 20:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def dealt(values: np.ndarray, by: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The values of each number in `by`."""
    order = np.argsort(by, kind="stable")
    values, by = values[order], by[order]
    cuts = [0, *(np.flatnonzero(np.diff(by)) + 1).tolist(), len(by)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield int(by[a]), values[a:b]


def run_rows(found: np.ndarray) -> Iterator[tuple[int, int, int, bytes]]:
    """Runs as rows, one for each part that they lie in."""
    for part, own in dealt(found, found["at"] >> PART_BITS):
        yield RUNS, part, part, own.tobytes()


def in_groups(key: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[int, list[dict]]]]:
    """The rows of each key of a partition that is sorted by it."""
    def group(found: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
        rows = (row for batch in found for small in batches([batch], 8 << 20) for row in small.to_pylist())
        for value, own in groupby(rows, key=lambda row: row[key]):
            yield value, list(own)

    return group


def gathered(rows: list[dict], kind: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(row["blob"] for row in rows), kind)


def text_file(path: str, part: int) -> str:
    return f"{path}/texts-{part:06d}.parquet"


def write_parts(docs: DataFrame, path: str, buckets: int, parts: int, by: list[str]) -> DataFrame:
    """Write the ordered texts in parts below `path`. Returns the tiles by bucket, and the repeats that a part found in itself."""
    ordered = docs.repartitionByRange(parts, *by).sortWithinPartitions("doc_id", "tie")

    def write(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        base, at, own, writer = part << PART_BITS, 0, [], None
        for batch in batches(found, 4 << 20):
            if writer is None:
                where, name = store(text_file(path, part))
                where.create_dir(name.rsplit("/", 1)[0], recursive=True)
                draft = f"{name}.{uuid.uuid4().hex}.draft"
                out = where.open_output_stream(draft)
                writer = pq.ParquetWriter(out, batch.schema, compression="zstd", compression_level=1, use_dictionary=False)
            writer.write_batch(batch)
            data, offsets = texts(batch.column("text"))
            own.extend(tiles_of(data, offsets, base + at))
            at += len(data)
        if writer is None:
            return
        writer.close()
        out.close()
        where.move(draft, name)
        tiles, new = suffixes.firsts(np.concatenate([np.zeros(0, TILE), *own]))
        own.clear()
        yield from rows_of([(PART, part, part, b"")])
        yield from rows_of(run_rows(suffixes.runs(tiles["at"][~new], tiles["windows"][~new])))
        tiles = tiles[new]
        yield from rows_of(
            (TILES, bucket, part, held.tobytes())
            for bucket, held in dealt(tiles, (tiles["anchor"] % np.uint64(buckets)).astype(np.int64)))

    return ordered.select("doc_id", "text").mapInArrow(write, ROWS)


def compare_tiles(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a bucket's tiles: the repeats, and by part the tiles whose bytes are wanted."""
    def rows() -> Iterator[tuple[int, int, int, bytes]]:
        for bucket, own in in_groups("bucket")(found):
            yield from ((row["kind"], bucket, row["part"], row["blob"]) for row in own if row["kind"] != TILES)
            tiles, new = suffixes.firsts(gathered([row for row in own if row["kind"] == TILES], TILE))
            yield from run_rows(suffixes.runs(tiles["at"][~new], tiles["windows"][~new]))
            unsure = suffixes.doubtful(tiles[new])
            wanted = np.zeros(len(unsure), DOUBT)
            for name in ("anchor", "at", "windows", "place"):
                wanted[name] = unsure[name]
            _, of, count = np.unique(unsure["anchor"], return_inverse=True, return_counts=True)
            wanted["many"] = count[of] > MANY_TILES if len(count) else False
            yield from ((WANTED, bucket, part, held.tobytes()) for part, held in dealt(wanted, wanted["at"] >> PART_BITS))

    yield from rows_of(rows())


def strings_of(body: np.ndarray, at: int, wanted: np.ndarray) -> Iterator[tuple[int, int, bool, bytes]]:
    """The bytes of wanted tiles that lie in a body beginning at `at`: key, place, whether cut from a tile, bytes."""
    data = body.tobytes()
    for key, begin, windows, place, many in wanted.tolist():
        begin -= at
        if not many:
            yield key, begin + at, False, data[begin:begin + windows + WINDOW - 1]
            continue
        done = 0
        while done < windows:
            cell = (place - done) // PIECE_PLACES
            here = min(windows - done, place - done - cell * PIECE_PLACES + 1)
            anchor = begin + place
            common = data[anchor - cell * PIECE_PLACES:anchor - (cell + 1) * PIECE_PLACES + 1 + WINDOW]
            yield (xxhash.xxh3_64_intdigest(common, cell), begin + done + at, True,
                   data[begin + done:begin + done + here + WINDOW - 1])
            done += here


def fetch(path: str, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Reads the wanted tiles of each part; of equal pieces in a part all but the first are repeats."""
    def read(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[int, int, int, bytes]]:
            for part, own in in_groups("part")(found):
                wanted = gathered(own, DOUBT)
                wanted = wanted[np.argsort(wanted["at"])]
                seen: set[tuple[int, int]] = set()
                again: list[tuple[int, int]] = []
                for at, body, _, _ in read_part(path, part):
                    lo, hi = np.searchsorted(wanted["at"], [at, at + len(body)])
                    strings, held = [], []
                    for key, place, cut, data in strings_of(body, at, wanted[lo:hi]):
                        if cut:
                            name = (key, xxhash.xxh3_64_intdigest(data))
                            if name in seen:
                                again.append((place, len(data) - WINDOW + 1))
                                continue
                            seen.add(name)
                        strings.append((key, place, len(data), cut))
                        held.append(data)
                    strings = np.array(strings, STRING)
                    bucket = (strings["key"] % np.uint64(buckets)).astype(np.int64)
                    for number, rows_at in dealt(np.arange(len(strings)), bucket):
                        yield WANTED, number, part, b"".join(
                            [len(rows_at).to_bytes(8, "little"), strings[rows_at].tobytes(), *(held[i] for i in rows_at.tolist())])
                yield from run_rows(suffixes.runs(*np.array(again, np.int64).reshape(-1, 2).T))

        yield from rows_of(rows())

    return read


def merge_strings(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repeats among the strings of each bucket, by merged transforms of shards of strings with the same keys."""
    def rows() -> Iterator[tuple[int, int, int, bytes]]:
        for bucket, own in in_groups("bucket")(found):
            yield from ((RUNS, bucket, row["part"], row["blob"]) for row in own if row["kind"] == RUNS)
            strings, held = [np.zeros(0, STRING)], []
            for row in own:
                if row["kind"] == WANTED:
                    count = int.from_bytes(row["blob"][:8], "little")
                    strings.append(np.frombuffer(row["blob"], STRING, count, 8))
                    ends = (8 + count * STRING.itemsize + np.cumsum(strings[-1]["size"])).tolist()
                    held.extend(row["blob"][e - n:e] for e, n in zip(ends, strings[-1]["size"].tolist()))
            listed = np.concatenate(strings)
            order = np.lexsort((listed["at"], listed["key"])).tolist()
            marks: list[np.ndarray] = []
            for together in merged_together(order, listed, held):
                first: dict[bytes, int] = {}
                for i in together:
                    if first.setdefault(held[i], i) != i:
                        marks.append(np.arange(listed["at"][i], listed["at"][i] + listed["size"][i] - WINDOW + 1))
                kept = list(first.values())
                marks.append(suffixes.repeated([held[i] for i in kept], listed["at"][kept], SHARD_BYTES))
            places = np.concatenate([np.zeros(0, np.int64), *marks])
            yield from run_rows(suffixes.runs(places, np.ones(len(places), np.int64)))

    yield from rows_of(rows())


def merged_together(order: list[int], strings: np.ndarray, held: list[bytes]) -> Iterator[list[int]]:
    """Strings sorted by key, in lists of about `MERGED_BYTES`; those of one key stay together."""
    out, size = [], 0
    for _, own in groupby(order, key=strings["key"].tolist().__getitem__):
        own = list(own)
        out.extend(own)
        size += sum(len(held[i]) for i in own)
        if size >= MERGED_BYTES:
            yield out
            out, size = [], 0
    if out:
        yield out


def read_part(path: str, part: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.RecordBatch]]:
    """A part's texts, a batch at a time: the place of its first byte, all its bytes, the texts' offsets, the batch."""
    where, name = store(text_file(path, part))
    at = part << PART_BITS
    with where.open_input_file(name) as file:
        held = pq.ParquetFile(file)
        for group in range(held.num_row_groups):
            for batch in held.read_row_group(group).to_batches():
                data, offsets = texts(batch.column("text"))
                yield at, data, offsets, batch
                at += len(data)


def removed(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Every document of each part: its bytes, what the runs of the part cover of it, and the rest."""
    def remove(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, own in in_groups("part")(found):
            held = gathered([row for row in own if row["kind"] == RUNS], RUN)
            held = suffixes.runs(held["at"], held["windows"])
            for at, body, offsets, batch in read_part(path, part):
                lo, hi = np.searchsorted(held["at"], [at, at + len(body)])
                change = np.zeros(len(body) + 1, np.int32)
                np.add.at(change, held["at"][lo:hi] - at, 1)
                np.add.at(change, held["at"][lo:hi] + held["windows"][lo:hi] + WINDOW - 1 - at, -1)
                gone = np.cumsum(change[:-1]) > 0
                begins = gone.copy()
                begins[1:] &= ~gone[:-1]
                begins[offsets[:-1][offsets[:-1] < len(body)]] = gone[offsets[:-1][offsets[:-1] < len(body)]]
                kept = body[~gone].tobytes()
                lost = np.concatenate(([0], np.cumsum(gone)))[offsets]
                spans = np.concatenate(([0], np.cumsum(begins)))[offsets]
                rest = (offsets - lost).tolist()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(np.diff(lost)), pa.array(np.diff(spans)),
                     pa.array([kept[a:b] for a, b in zip(rest, rest[1:])], pa.large_binary()).cast(pa.binary())],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return remove


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document without its repeated strings: doc_id, n_bytes, n_removed, n_spans, kept (bytes).

    A byte goes if a string of 100 bytes that covers it also begins earlier: in a document with a smaller
    key, or earlier in the same one. Null keys come first; documents of one key are ordered by a hash of their text, and of rows that
    repeat key and text one comes first. Texts null or shorter than 100 bytes lose nothing; null is empty. `kept` may end
    inside a character. Long texts are cut into tiles piece by piece; a text is held by a task as a whole.
    """
    spark = docs.sparkSession
    path = fresh_path(spark, "repeats")
    rows = docs.select(F.col(key).alias("doc_id"), text_or_empty(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    sums = rows.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    copies, size = sums.agg(F.max("n"), F.sum("bytes")).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(size or 0) // PART_BYTES))
    buckets = 4 * parts
    tied = rows.withColumn("tie", F.xxhash64("text")).withColumn("spread", F.xxhash64(F.monotonically_increasing_id()))
    # The ties, for which the sample of the ranges reads all texts, matter where one key has many rows.
    by = ["doc_id", "tie", "spread"] if (copies or 0) > ROW_COPIES else ["doc_id"]
    tiled = write_parts(tied, path, buckets, parts, by)
    found = written(
        tiled.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(compare_tiles, ROWS), "repeat-tiles")
    wanted = found.filter(F.col("kind") == WANTED)
    fetched = wanted.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(fetch(path, buckets), ROWS)
    merged = fetched.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(merge_strings, ROWS)
    runs = found.filter(F.col("kind") != WANTED).unionByName(written(merged, "repeat-runs"))
    return runs.select("kind", "part", "blob").repartition(parts, "part").sortWithinPartitions("part").mapInArrow(
        removed(path), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
