"""N-gram Jaccard join in metric space: pivots, regions, triangle-inequality windows, recursion.

Jaccard distance is a metric, but with documents as the only pivots nearly all distances
are 1 and every window holds everything. So the first levels use pivots that tell
documents apart, and documents serve as pivots within the regions these leave:

1. The universe of all shingles as pivot: the distance to it orders documents by size. Bands of sizes are
   the regions; a document also goes to the lower band that its window reaches, where partners may be smaller.
2. Slices of the universe by hash as pivots, in symmetric-difference distance. Two documents within the
   window of a band differ in at most t shingles, so of t + 1 slices they agree on one
   whole. The content of a slice is the region. Slices that hold few shingles say little: some
   more slices than t + 1 are cut, and a document leaves out its light ones as long as these are no more than
   the surplus. A document alone in all its regions links with nothing; few go on.
3. Single shingles as pivots, rarest first. A shingle that only one of two documents holds costs them a unit
   of distance, so linked documents share one of their first shingles before the window is used up, and the places of
   that shingle in both bound their distance. The order is by counts over all documents that came this far.
4. Documents as pivots, recursively: a document is compared, exactly, with the best pivot of the regions it lies in.
   It falls into a ring one threshold wide around that pivot, and by the triangle inequality linked documents lie in
   the same ring or in neighbouring ones. A region whose members are all connected already is done; the others
   go on, and their members meet further pivots. After `ROUNDS` of these the members left meet in cells of bounded size, by
   recursive Voronoi regions around pivots, with boundary members copied as far as the triangle inequality asks.

Before sets are compared their parities are: a bitmap in which every shingle flips one bit. Two sets' bitmaps differ in no more
bits than the sets in shingles, so a pair whose bitmaps differ in more than linked sets may is no link, and its sets stay where they are.
Regions travel in packed blobs, sorted by region, and a region that one set alone has ends in the task that sees it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lakecat.llm.common import batch_rows, batches, hash_filter, passes, release, small
from lakecat.llm.components import components
from lakecat.session import written

ROUNDS = 1  # pivots connect most of a family in the first; what is left are few links, which cells find in one go
BAND_RATIO = 1.5
MOST_WORDS = 120_000  # words whose hash a worker remembers; then it starts anew


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= MOST_WORDS:
                self.clear()
            self[word] = value
        return value


WORDS = WordHashes()
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes | None, words: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes.

    Letters A to Z are lower-cased, words lie between ASCII white space, and a shingle is `words` of
    them in a row; fewer words are one shingle together. Null or no words: empty.
    """
    found = (text or b"").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        hashes = np.fromiter(map(WORDS.__getitem__, found), np.uint64, len(found))
        span = min(words, len(found))
        total = np.full(len(found) - span + 1, span, np.uint64)
        for i in range(span):  # word hashes are random, so a sum with odd factors tells sequences apart
            total += hashes[i:len(found) - span + 1 + i] * np.uint64(FACTORS[i % len(FACTORS)] + 2 * (i // len(FACTORS)))
        total = mixed(total)
    total.sort()
    return total if len(total) < 2 else total[np.concatenate(([True], total[1:] != total[:-1]))]


def set_id(shingles: np.ndarray) -> int:
    """A 64-bit name of a set, equal for equal sets."""
    with np.errstate(over="ignore"):
        total = mixed(shingles + np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(mixed(np.array([total], np.uint64)).view(np.int64)[0])


class Bands:
    """The size bands, and the slices of each, for links at `percent` or more."""

    def __init__(self, percent: int):
        self.percent = percent
        self.edges = [1]

    def band(self, size: int) -> int:
        while self.edges[-1] <= size:
            self.edges.append(max(self.edges[-1] + 1, int(self.edges[-1] * BAND_RATIO)))
        return int(np.searchsorted(self.edges, size, "right")) - 1

    def slices(self, band: int) -> tuple[int, int, int]:
        """Number of slices, of surplus ones among them, and the size up to which a slice is light."""
        low, high = self.edges[band], self.edges[band + 1] - 1
        differ = high * (100 - self.percent) // self.percent
        if not differ:
            return 0, 0, 0
        mean = low / (differ + 1)
        light = int(mean / 3)
        share = sum(math.exp(-mean) * mean ** i / math.factorial(i) for i in range(light + 1))
        expected = (differ + 1) * min(1.0, share)
        surplus = math.ceil(expected + 2 * math.sqrt(expected))
        return differ + 1 + surplus, surplus, light

    def regions(self, shingles: np.ndarray) -> np.ndarray:
        """The regions of a set: one 64-bit name per band it may meet a partner in and slice.

        Sets that link and differ share a region.
        """
        size, out = len(shingles), []
        if not size:
            return np.zeros(0, np.int64)
        top = self.band(size)
        for band in range(self.band(-(-size * self.percent // 100)), top + 1):
            slices, surplus, light = self.slices(band)
            if not slices:
                continue
            with np.errstate(over="ignore"):
                place = ((shingles >> np.uint64(32)) * np.uint64(slices)) >> np.uint64(32)
                edges = np.searchsorted(place, np.arange(slices + 1, dtype=np.uint64))
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(shingles ^ np.uint64(band + 1)))])
                counts = np.diff(edges)
                name = sums[edges[1:]] - sums[edges[:-1]] + counts.astype(np.uint64)
                name = mixed(name + mixed(np.arange(slices, dtype=np.uint64) + np.uint64((band + 1) << 32)))
            kept = counts > light
            if slices - int(kept.sum()) <= surplus:
                name = name[kept]
            out.append(name.view(np.int64))
        return np.concatenate(out) if out else np.zeros(0, np.int64)


def lean(run):
    """A task's function that leaves no words and no freed memory behind in its worker."""
    def task(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(found)
        WORDS.clear()
        release()

    return task


def texts_of(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def packed(*columns: np.ndarray) -> bytes:
    """Rows of non-negative numbers, sorted by the first column: that one as differences, each column in as few bytes as it needs."""
    order = np.argsort(columns[0], kind="stable")
    out = [len(order).to_bytes(8, "little")]
    for i, column in enumerate(columns):
        values = column[order].astype(np.uint64)
        if not i:
            values = np.diff(values, prepend=np.uint64(0))
        width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
        out += [bytes([width]), values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()]
    return b"".join(out)


def unpacked(blob: bytes) -> list[np.ndarray]:
    rows, at, out = int.from_bytes(blob[:8], "little"), 8, []
    while at < len(blob):
        width = blob[at]
        values = np.zeros((rows, 8), np.uint8)
        values[:, :width] = np.frombuffer(blob, np.uint8, rows * width, at + 1).reshape(rows, width)
        out.append(values.view("<u8")[:, 0])
        at += 1 + rows * width
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out


BLOBS = "bucket long, blob binary"
#: Rows that a task gathers before it deals them to buckets, and buckets of regions for each partition.
GATHERED_ROWS, BUCKETS = 300_000, 4


class Dealer:
    """Gathers rows (region, ...) and deals them to buckets by the first bits of the region, as packed blobs."""

    def __init__(self, bucket_bits: int):
        self.bits, self.held, self.rows = bucket_bits, [], 0

    def add(self, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(columns[0]):
            self.held.append(columns)
            self.rows += len(columns[0])
        if self.rows > GATHERED_ROWS:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            columns = [np.concatenate(x) for x in zip(*self.held)]
            self.held, self.rows = [], 0
            bucket = (columns[0] >> np.uint64(64 - self.bits)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            numbers, blobs = [], []
            for a, b in zip(cuts, [*cuts[1:], len(order)]):
                numbers.append(int(bucket[order[a]]))
                blobs.append(packed(*(column[order[a:b]] for column in columns)))
            for at in range(0, len(blobs), 64):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers[at:at + 64], pa.int64()), pa.array(blobs[at:at + 64], pa.binary())], names=["bucket", "blob"])


def bucket_bits(spark) -> int:
    return max(1, (BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())


def buckets_of(found: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of each bucket of a partition that is sorted by bucket."""
    rows = ((row["bucket"], row["blob"]) for batch in found for small in batches([batch], 8 << 20) for row in small.to_pylist())
    for _, own in groupby(rows, key=lambda row: row[0]):
        yield [np.concatenate(x) for x in zip(*(unpacked(blob) for _, blob in own))]


def gathered(blobs: DataFrame, use, schema: str) -> DataFrame:
    """`use` over the buckets of each partition."""
    parts = int(blobs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blobs.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(use, schema)


#: Bits of the tag of a set by which regions tell sets apart; a candidate too many does no harm, and one too few is as rare as 2 ** -48.
TAG_BITS = 48


def shared(region: np.ndarray, tag: np.ndarray) -> np.ndarray:
    """Which rows, sorted by region and tag, lie in a region with several tags."""
    if not len(region):
        return np.zeros(0, bool)
    new = np.concatenate(([True], region[1:] != region[:-1]))
    other = np.concatenate(([False], (region[1:] == region[:-1]) & (tag[1:] != tag[:-1])))
    return np.logical_or.reduceat(other, np.flatnonzero(new))[np.cumsum(new) - 1]


def candidate_tags(docs: DataFrame, words: int, percent: int, region_bits: int) -> DataFrame:
    """The tags of sets that share a region with another set: one row each."""
    bits = bucket_bits(docs.sparkSession)

    def find(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, dealer = Bands(percent), Dealer(bits)
        keep = ~np.uint64((1 << 64 - region_bits) - 1)
        for batch in batches(found, 1 << 20):
            regions, tags = [], []
            for text in texts_of(batch):
                shingles = shingle_set(text, words)
                own = bands.regions(shingles).view(np.uint64) & keep
                regions.append(own)
                tags.append(np.full(len(own), set_id(shingles) & ((1 << TAG_BITS) - 1), np.uint64))
            yield from dealer.add(np.concatenate(regions), np.concatenate(tags))
        yield from dealer.flush()

    def several(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for region, tag in buckets_of(found):
            order = np.lexsort((tag, region))
            tags = np.unique(tag[order][shared(region[order], tag[order])])
            yield pa.RecordBatch.from_arrays([pa.array(tags.astype(np.int64))], names=["tag"])

    return gathered(docs.select("text").mapInArrow(lean(find), BLOBS), lean(several), "tag long").distinct()


def membership(docs: DataFrame, words: int) -> DataFrame:
    """One row per document: doc_id, doc_hash, n_shingles, id."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def find(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(found, 1 << 20):
            held = [shingle_set(text, words) for text in texts_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("doc_hash"), pa.array([len(x) for x in held], pa.int64()),
                 pa.array([set_id(x) for x in held], pa.int64())], names=["doc_id", "doc_hash", "n_shingles", "id"])

    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("doc_hash"), "text").mapInArrow(
        lean(find), f"doc_id {kind}, doc_hash long, n_shingles long, id long")


def sets_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """The shingles of the wanted sets: id, items, by the hashes of one document each.

    A few more sets come along, and rows that repeat a document bring its set again; neither changes what is linked.
    """
    filter_ = docs.sparkSession.sparkContext.broadcast(hash_filter(wanted, "doc_hash"))

    def find(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = filter_.value
        for batch in batches(found, 4 << 20):
            hashes = batch.column("doc_hash").to_numpy().view(np.uint64)
            batch = batch.filter(pa.array(passes(bits, hashes)))
            for small in batches([batch] if batch.num_rows else [], 1 << 20):
                held = [x for x in (shingle_set(text, words) for text in texts_of(small)) if len(x)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_id(x) for x in held], pa.int64()),
                     pa.array([x.view(np.int64) for x in held], pa.list_(pa.int64()))], names=["id", "items"])

    return docs.select(F.xxhash64("doc_id", "text").alias("doc_hash"), "text").mapInArrow(lean(find), "id long, items array<long>")


LEAST_PARITY, MOST_PARITY, FLAT_PARITY = 256, 1 << 16, 1 << 10  # bits


def parity(shingles: np.ndarray, percent: int, width: int | None = None) -> bytes:
    """A bitmap in which every shingle flips one bit, of four bits for each shingle that linked sets may differ in, about."""
    differ = len(shingles) * 2 * (100 - percent) // (100 + percent)
    width = width or min(MOST_PARITY, max(LEAST_PARITY, 1 << (4 * differ).bit_length()))
    places = (mixed(shingles + np.uint64(0xA0761D6478BD642F)) & np.uint64(width - 1)).astype(np.int64)
    return np.packbits(np.bincount(places, minlength=width).astype(np.uint8) & 1).tobytes()


def parities(sets: DataFrame, percent: int) -> DataFrame:
    """(id, n, bits, flat) of every set, once; `flat` has `FLAT_PARITY` bits whatever the size."""
    def find(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(found, 1 << 20):
            items = batch.column("items")
            offsets, values = items.offsets.to_numpy(), items.values.to_numpy().view(np.uint64)
            own = [values[a:b] for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(x) for x in own], pa.int64()),
                 pa.array([parity(x, percent) for x in own], pa.binary()),
                 pa.array([parity(x, percent, FLAT_PARITY) for x in own], pa.binary())], names=["id", "n", "bits", "flat"])

    return sets.mapInArrow(lean(find), "id long, n long, bits binary, flat binary").dropDuplicates(["id"])


def apart(one: bytes, other: bytes) -> int:
    """In how many bits two parities differ, the wider one folded to the other's width."""
    one, other = sorted((np.frombuffer(one, np.uint8), np.frombuffer(other, np.uint8)), key=len)
    other = np.bitwise_xor.reduce(other.reshape(-1, len(one)), axis=0)
    return int(np.bitwise_count(one ^ other).sum())


def likely(pairs: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, ...) whose parities do not rule a link out; no pair that links is lost."""
    sides = [bitmaps.select(F.col("id").alias(end), F.col("n").alias(f"n_{end}"), F.col("bits").alias(f"bits_{end}")) for end in "ab"]
    met, columns = pairs.join(sides[0], "a").join(sides[1], "b"), pairs.columns

    def keep(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            n = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            most = n * (100 - percent) // (100 + percent)
            near = [apart(x.as_py(), y.as_py()) <= m for x, y, m in zip(batch.column("bits_a"), batch.column("bits_b"), most.tolist())]
            yield batch.select(columns).filter(pa.array(near, pa.bool_()))

    return met.select(*columns, "n_a", "n_b", "bits_a", "bits_b").mapInArrow(keep, pairs.schema)


#: Bytes of sets that meet in one task at a time, on average, and the sets that one copy of a pivot's set serves.
MET_BYTES, SERVED = 8 << 20, 512


def compared(pairs: DataFrame, sets: DataFrame, set_bytes: float) -> DataFrame:
    """`pairs` (a, b) with the sizes of intersection and union, as a written table.

    The set of every a is sent to its b once a pair; that of b, a pivot of many, once to `SERVED` of them. `set_bytes` is a mean.
    """
    pairs = written(pairs.select("a", "b"), "jaccard-pairs")
    number = pairs.count()
    buckets = max(int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(number * set_bytes / MET_BYTES))
    served = pairs.groupBy("b").count().select("b", F.ceil(F.col("count") / SERVED).alias("parts"))
    dealt = pairs.join(served, "b").withColumn("part", F.pmod(F.xxhash64("a"), F.col("parts"))).withColumn(
        "bucket", F.pmod(F.xxhash64("b", "part"), F.lit(buckets))).select("a", "b", "bucket")
    dealt = written(dealt, "jaccard-dealt")
    left = small(dealt).join(sets.withColumnRenamed("id", "a"), "a").select("bucket", "a", "b", "items")
    pivots = dealt.select(F.col("bucket").alias("at"), F.col("b").alias("pivot")).distinct()
    right = small(pivots).join(sets.select(F.col("id").alias("pivot"), F.col("items").alias("held")), "pivot").select("at", "pivot", "held")

    def meet(ours: pa.Table, pivots: pa.Table) -> pa.Table:
        def own(column: pa.ChunkedArray) -> list[np.ndarray]:
            lists = column.combine_chunks()
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            return [values[x:y] for x, y in zip(offsets, offsets[1:])]

        pivot = dict(zip(pivots["pivot"].to_pylist(), own(pivots["held"])))
        both, either = [], []
        for items, b in zip(own(ours["items"]), ours["b"].to_pylist()):
            both.append(len(np.intersect1d(items, pivot[b], assume_unique=True)))
            either.append(len(items) + len(pivot[b]) - both[-1])
        return pa.table({"a": ours["a"], "b": ours["b"], "both": pa.array(both, pa.int64()), "either": pa.array(either, pa.int64())})

    found = left.groupBy("bucket").cogroup(right.groupBy("at")).applyInArrow(meet, "a long, b long, both long, either long")
    return written(found, "jaccard-compared")


def linked(percent: int) -> Column:
    return F.col("both") * 100 >= F.col("either") * percent


#: Counters of the shingle order; more shingles than that share counters, which only blurs the order.
COUNTERS = 1 << 19
CHUNK = 1 << 14


def shingle_counts(sets: DataFrame) -> np.ndarray:
    """How many sets hold the shingles of each counter: `COUNTERS` sums over all sets, whatever their number."""
    def count(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in found:
            items = batch.column("items").flatten().to_numpy().view(np.uint64)
            total += np.bincount((items & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(COUNTERS // CHUNK), pa.int64()),
             pa.array([x.astype(np.int32).tobytes() for x in total.reshape(-1, CHUNK)], pa.binary())],
            names=["chunk", "counts"])

    def add(table: pa.Table) -> pa.Table:
        counts = sum(np.frombuffer(x.as_py(), np.int32).astype(np.int64) for x in table["counts"])
        return pa.table({"chunk": table["chunk"][:1], "counts": pa.array([counts.astype(np.int64).tobytes()], pa.binary())})

    kind = "chunk long, counts binary"
    sums = sets.select("items").mapInArrow(count, kind).groupBy("chunk").applyInArrow(add, kind)
    out = np.zeros(COUNTERS, np.int64)
    for row in sums.collect():  # COUNTERS numbers in all
        out[row["chunk"] * CHUNK:(row["chunk"] + 1) * CHUNK] = np.frombuffer(bytes(row["counts"]), np.int64)
    return out


def first_shingles(sets: DataFrame, percent: int) -> DataFrame:
    """(region, id, n, pos): the shingles of each set that a partner must share one of, rarest first, if another set has them too."""
    counts = shingle_counts(sets)
    mean = max(1.0, counts.sum() / max(1, np.count_nonzero(counts)))
    ranks = sets.sparkSession.sparkContext.broadcast(
        np.clip(np.log2(np.maximum(counts, 1) / mean), 0, 60).astype(np.uint8))
    bits = bucket_bits(sets.sparkSession)

    def find(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealer = Dealer(bits)
        for batch in batches(found, 1 << 20):
            items = batch.column("items")
            offsets, values = items.offsets.to_numpy(), items.values.to_numpy().view(np.uint64)
            for row, id_ in enumerate(batch.column("id").to_pylist()):
                own = values[offsets[row]:offsets[row + 1]]
                rank = ranks.value[(own & np.uint64(COUNTERS - 1)).astype(np.int64)]
                kept = len(own) - -(-len(own) * percent // 100) + 1
                first = own[np.lexsort((own, rank))[:kept]]
                yield from dealer.add(
                    first, np.full(len(first), id_, np.int64).view(np.uint64), np.full(len(first), len(own), np.uint64),
                    np.arange(len(first), dtype=np.uint64))
        yield from dealer.flush()

    def several(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in buckets_of(found):
            order = np.lexsort((columns[1], columns[0]))
            columns = [column[order] for column in columns]
            kept = shared(columns[0], columns[1])
            kept[1:] &= (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])  # a set that came twice
            yield pa.RecordBatch.from_arrays(
                [pa.array(column[kept].view(np.int64)) for column in columns], names=["region", "id", "n", "pos"])

    return gathered(sets.mapInArrow(lean(find), BLOBS), lean(several), "region long, id long, n long, pos long")


def within(percent: int, x: str, y: str) -> Column:
    """Whether two members of a region may link, by their sizes, the places of the region's shingle, and their rings."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    sizes = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    shared = F.least(n - F.col(f"{x}.pos"), m - F.col(f"{y}.pos"))
    places = shared * (100 + percent) >= (n + m) * percent
    apart = (F.col(f"{x}.pivot") == F.col(f"{y}.pivot")) & (F.abs(F.col(f"{x}.ring") - F.col(f"{y}.ring")) > 1)
    return sizes & places & ~F.coalesce(apart, F.lit(False)) & (F.col(f"{x}.label") != F.col(f"{y}.label"))


#: Rows of one side of a cell, in which the members of a region meet, and rows that a task holds at a time.
CELL_ROWS, HELD_ROWS = 2_048, 20_000


#: Members of a Voronoi region that are compared one by one, pivots of a larger one, and what share of its pairs its parts may have.
REGION_ROWS, REGION_PIVOTS, WORTH = 256, 64, 0.5


def hamming(flat: np.ndarray, other: np.ndarray) -> np.ndarray:
    return np.bitwise_count(flat ^ other).sum(axis=-1, dtype=np.int64)


def voronoi(cell: dict[str, np.ndarray], rows: np.ndarray, percent: int) -> list[np.ndarray] | None:
    """The Voronoi regions of some members around pivots far from each other; None where pivots do not part them.

    Parities have a metric, the number of bits in which they differ, and linked sets are no further apart in it than t, the most
    shingles that linked sets of these sizes differ in. If x lies nearest to pivot p, a linked y has d(y, p) <= d(x, p) + t, and that is
    no more than d(y, q) + 2t for the pivot q nearest to y. So a member also goes to every region whose pivot is within 2t
    of its nearest one, and linked members meet in a region.
    """
    flat, most = cell["flat"][rows], 2 * int(cell["n"][rows].max()) * (100 - percent) // (100 + percent)
    distances, pivot = [], 0
    while len(distances) < REGION_PIVOTS:
        distances.append(hamming(flat, flat[pivot]))
        nearest = np.min(distances, axis=0)
        pivot = int(nearest.argmax())
        if nearest[pivot] <= 2 * most:  # every member is close to a pivot
            break
    found = np.column_stack(distances)
    inside = found - found.min(axis=1, keepdims=True) <= 2 * most
    sizes = inside.sum(axis=0)
    if (sizes.astype(float) ** 2).sum() > WORTH * float(len(rows)) ** 2:
        return None
    return [rows[own] for own in inside.T if own.sum() > 1]


def near_among(cell: dict[str, np.ndarray], rows: np.ndarray, percent: int) -> np.ndarray:
    """(a, b) of some members that `within` allows and whose flat parities do too; members of different sides, where there are two."""
    out, cross = [np.zeros((0, 2), np.int64)], cell["low"][rows[0]] != cell["high"][rows[0]]
    right = {name: values[rows] for name, values in cell.items()}
    for first in range(0, len(rows), 256):
        one = {name: values[first:first + 256, None] for name, values in right.items() if name != "flat"}
        n, m = one["n"], right["n"]
        may = (one["label"] != right["label"]) & (np.minimum(n, m) * 100 >= np.maximum(n, m) * percent)
        may &= np.minimum(n - one["pos"], m - right["pos"]) * (100 + percent) >= (n + m) * percent
        may &= ~((one["pivot"] == right["pivot"]) & (one["ring"] >= 0) & (right["ring"] >= 0) & (np.abs(one["ring"] - right["ring"]) > 1))
        may &= np.arange(first, first + len(n))[:, None] < np.arange(len(m))
        if cross:
            may &= one["side"] != right["side"]
        i, j = np.nonzero(may)
        for at in range(0, len(i), 1 << 16):
            x, y = i[at:at + (1 << 16)] + first, j[at:at + (1 << 16)]
            kept = hamming(right["flat"][x], right["flat"][y]) <= (m[x] + m[y]) * (100 - percent) // (100 + percent)
            a, b = right["id"][x[kept]], right["id"][y[kept]]
            out.append(np.column_stack([np.minimum(a, b), np.maximum(a, b)]))
    return np.unique(np.concatenate(out), axis=0)


def near_in_cell(cell: dict[str, np.ndarray], percent: int) -> np.ndarray:
    """The near pairs of a cell, by Voronoi regions in regions, until these are small or pivots do not part them."""
    out, open_ = [], [np.arange(len(cell["id"]))]
    while open_:
        rows = open_.pop()
        parts = voronoi(cell, rows, percent) if len(rows) > REGION_ROWS else None
        if parts is None:
            out.append(near_among(cell, rows, percent))
        else:
            open_ += parts
    return np.unique(np.concatenate(out), axis=0)


def near_in_regions(rows: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of members of one region, with different labels, that sizes, places, rings and parities do not rule out.

    The members of a region are dealt to sides of `CELL_ROWS`, and every two sides meet in a cell, so a hot region is many
    tasks. In a cell, members that are near by their parities meet by Voronoi regions; only pairs that may link leave the task.
    """
    spark = rows.sparkSession
    rows = written(rows, "jaccard-rest")
    sides = rows.groupBy("region").agg(F.ceil(F.count("*") / CELL_ROWS).cast("int").alias("sides"))
    side = F.pmod(F.xxhash64("id"), F.col("sides")).cast("int")
    dealt = (
        rows.join(sides, "region").join(bitmaps.select("id", "flat"), "id").withColumn("side", side)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
        .withColumn("low", F.least("side", "other")).withColumn("high", F.greatest("side", "other")))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // HELD_ROWS)
    dealt = dealt.withColumn("bucket", F.pmod(F.xxhash64("region", "low", "high"), F.lit(buckets)))

    def meet(table: pa.Table) -> pa.Table:
        columns = {name: table[name].fill_null(-1).to_numpy() for name in (
            "region", "low", "high", "side", "id", "n", "pos", "label", "pivot", "ring")}
        flat = table["flat"].combine_chunks()  # of one size each
        start = int(np.frombuffer(flat.buffers()[1], np.int32)[flat.offset])
        columns["flat"] = np.frombuffer(flat.buffers()[2], np.uint64, len(flat) * FLAT_PARITY // 64, start).reshape(len(flat), -1)
        order = np.lexsort((columns["high"], columns["low"], columns["region"]))
        columns = {name: values[order] for name, values in columns.items()}
        new = np.zeros(len(order), bool)
        for name in ("region", "low", "high"):
            new[1:] |= columns[name][1:] != columns[name][:-1]
        cuts = [0, *np.flatnonzero(new).tolist(), len(order)]
        found = [np.zeros((0, 2), np.int64)]
        for a, b in zip(cuts, cuts[1:]):
            if b - a < 2:
                continue
            found.append(near_in_cell({name: values[a:b] for name, values in columns.items()}, percent))
        pairs = np.unique(np.concatenate(found), axis=0)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return dealt.groupBy("bucket").applyInArrow(meet, "a long, b long").distinct()


def links_between(regions: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect exactly the sets that all links connect. `regions`: region, id, n, pos.

    The pivot of a region is the member with the fewest rarer shingles, which edited copies have more of.
    In a round each set is compared with the best pivot of its regions that it is not connected to and that its parity allows.
    """
    bitmaps = written(parities(sets, percent), "jaccard-parities")
    set_bytes = 8 * (bitmaps.agg(F.avg("n")).first()[0] or 0)
    # Of regions with the same members the one whose shingle comes first bounds them best; the others add nothing.
    regions = written(regions, "jaccard-shared")
    members = regions.groupBy("region").agg(
        F.count("*").alias("size"), F.bit_xor(F.xxhash64("id")).alias("members"), F.sum("pos").alias("pos"))
    first = members.groupBy("size", "members").agg(F.min(F.struct("pos", "region"))["region"].alias("region"))
    rows = written(
        regions.join(first.select("region"), "region", "left_semi").select(
            "region", "id", "n", "pos", F.col("id").alias("label"), F.lit(None).cast("long").alias("pivot"),
            F.lit(None).cast("long").alias("ring")), "jaccard-regions")
    columns = rows.columns
    found = tested = None
    for _ in range(ROUNDS):
        pivots = rows.groupBy("region").agg(
            F.min(F.struct("pos", "id", "n", "label", "pivot", "ring")).alias("p")).select("region", "p.*")
        x, p = rows.alias("x"), pivots.alias("p")
        near = x.join(p, (F.col("x.region") == F.col("p.region")) & within(percent, "x", "p")).select(
            F.col("x.id").alias("a"), F.col("p.id").alias("b"), F.col("p.pos").alias("pos")).groupBy("a", "b").agg(F.min("pos").alias("pos"))
        if tested is not None:
            near = near.join(tested, ["a", "b"], "left_anti")
        pairs = likely(near, bitmaps, percent).groupBy("a").agg(F.min(F.struct("pos", "b"))["b"].alias("b"))
        results = compared(pairs, sets, set_bytes)
        tested = results.select("a", "b") if tested is None else tested.union(results.select("a", "b"))
        new = results.filter(linked(percent)).select("a", "b")
        found = new if found is None else found.union(new)
        ring = F.expr(f"(either - both) * 100 div (either * {100 - percent})")
        rings = results.select(F.col("a").alias("id"), F.col("b").alias("new_pivot"), ring.alias("new_ring")).dropDuplicates(["id"])
        labels = components(found).select(F.col("v").alias("id"), F.col("label").alias("new_label"))
        moved = rows.join(labels, "id", "left").withColumn("label", F.coalesce("new_label", "label")).select(*columns)
        mixed_ = moved.groupBy("region").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi")
        rows = written(moved.join(mixed_.select("region"), "region", "left_semi").join(rings, "id", "left").select(
            "region", "id", "n", "pos", "label", F.coalesce("new_pivot", "pivot").alias("pivot"),
            F.when(F.col("new_pivot").isNotNull(), F.col("new_ring")).otherwise(F.col("ring")).alias("ring")), "jaccard-regions")
        if not rows.limit(1).count():
            return found
    pairs = near_in_regions(rows, bitmaps, percent).join(tested, ["a", "b"], "left_anti")
    return found.union(compared(likely(pairs, bitmaps, percent), sets, set_bytes).filter(linked(percent)).select("a", "b"))


#: Texts or sets that Spark hands to Python at a time.
BATCH_ROWS = 1_000


def jaccard_components(
    docs: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, doc_hash, n_shingles, component, component_id.

    Two documents link when 100 * intersection >= percent * union of their shingle sets; a component is all
    that links reach, and component_id is its smallest doc_id. Documents without shingles have component null and
    their own id. Copies are one set throughout. Null ids never name a component unless all its ids are null.
    `doc_hash` is the hash of id and text. The result is a written table. Links are not returned
    nor counted: pairs whose ends are known to be in one component are not compared.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    with batch_rows(docs.sparkSession, BATCH_ROWS):
        return found_components(rows, words, percent)


def found_components(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """`jaccard_components` of (doc_id, text)."""
    members = written(membership(rows, words), "jaccard-members")
    # So many bits that chance makes few documents share a region.
    region_bits = min(64, max(40, (members.count() << 8).bit_length() + 16))
    tags = written(candidate_tags(rows, words, percent, region_bits), "jaccard-tags")
    tag = F.col("id").bitwiseAND((1 << TAG_BITS) - 1).alias("tag")
    several = members.filter("n_shingles > 0").select("id", "doc_hash", tag).join(tags, "tag", "left_semi")
    wanted = written(several.groupBy("id").agg(F.min("doc_hash").alias("doc_hash")), "jaccard-wanted")
    sets = written(sets_of(rows, wanted, words), "jaccard-sets")
    labels = components(links_between(first_shingles(sets, percent), sets, percent))
    named = members.join(labels, members["id"] == labels["v"], "left").withColumn(
        "component", F.when(F.col("n_shingles") > 0, F.coalesce("label", "id"))).drop("v", "label", "id")
    smallest = named.filter("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("smallest"))
    return written(
        named.join(smallest, "component", "left").withColumn("component_id", F.when(
            F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("smallest"))).drop("smallest"),
        "jaccard-components")
