"""Sharding by bytes: minimax contiguous partition of ordered atomic groups."""

from __future__ import annotations

import math
from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame, Window, functions as F

from lakecat.llm.common import small, task_count, text_or_empty
from lakecat.session import written

PLACE_BITS = 60
#: Blocks of the first look at the order, and how many more bits each closer look resolves.
FIRST_BITS, MORE_BITS = 13, 6
ROWS_PER_BUCKET = 50_000


def greedy(sizes: list[int], capacity: int, shards: int) -> list[int] | None:
    """Ends (exclusive) of at most `shards` runs of `sizes`, each as long as `capacity` allows; None if too few."""
    sums = [0, *accumulate(sizes)]
    ends, at = [], 0
    while at < len(sizes):
        end = bisect_right(sums, sums[at] + capacity) - 1
        if end == at or len(ends) == shards:
            return None
        ends.append(end)
        at = end
    return ends


def smallest_capacity(sizes: list[int], shards: int) -> int:
    """The smallest capacity with which greedy runs cover all sizes in `shards` shards, by binary search."""
    low = max(max(sizes, default=0), math.ceil(sum(sizes) / shards))
    high = low + max(sizes, default=0)
    while low < high:
        middle = (low + high) // 2
        if greedy(sizes, middle, shards) is None:
            low = middle + 1
        else:
            high = middle
    return low


@dataclass
class Block:
    start: int  # first place
    bits: int  # the block spans 2 ** bits places
    size: int
    largest: int  # size of its largest group
    groups: int


def split_places(blocks: list[Block], shards: int) -> tuple[list[int], set[int]]:
    """Cut places at this resolution, and the blocks that a closer look might cut.

    With blocks as atoms, the smallest capacity is an upper bound of the true one. The
    lower bound is the mean shard or the largest group. The first j shards hold no more than j times the upper
    bound, and no less than what the others leave at the upper bound; nor does the j-th cut come before the greedy runs of the
    lower bound over whole blocks.
    """
    sizes = [b.size for b in blocks]
    sums = [0, *accumulate(sizes)]
    upper = smallest_capacity(sizes, shards)
    lower = max(math.ceil(sums[-1] / shards), max(b.largest for b in blocks))
    ends = greedy(sizes, upper, shards)
    cuts = [blocks[e].start for e in ends if e < len(blocks)]
    open_blocks: set[int] = set()
    if upper > lower:
        at = 0
        for j in range(1, shards):
            stop = bisect_right(sums, sums[at] + lower) - 1
            stop = max(stop, bisect_right(sums, sums[-1] - (shards - j) * upper - 1) - 1)
            last = bisect_right(sums, min(j * upper, sums[-1])) - 1
            open_blocks.update(range(max(0, stop), min(len(blocks) - 1, last) + 1))
            at = max(at, stop)
    return cuts, {i for i in open_blocks if blocks[i].groups > 1 and blocks[i].bits > 0}


def minimax_cuts(groups: DataFrame, shards: int) -> list[int]:
    """Places at which to cut the order of `groups` (place, size), so that the largest shard is smallest.

    The driver sees sums over blocks of the order. Blocks that may hold a cut are
    resolved further until they are single places; a look returns a bounded number of sums,
    however many groups there are.
    """
    def look(found: DataFrame, bits: int) -> list[Block]:
        rows = (
            found.groupBy(F.shiftright("place", bits).alias("block"))
            .agg(F.sum("size").alias("size"), F.max("size").alias("largest"), F.count("*").alias("groups"))
            .orderBy("block").collect()  # at most the blocks asked for
        )
        return [Block(r["block"] << bits, bits, r["size"], r["largest"], r["groups"]) for r in rows]

    bits = PLACE_BITS - FIRST_BITS
    blocks = look(groups, bits)
    while blocks:
        cuts, unsure = split_places(blocks, shards)
        if not unsure:
            return cuts
        coarsest = max(blocks[i].bits for i in unsure)
        chosen = {i for i in unsure if blocks[i].bits == coarsest}
        finer = max(0, coarsest - MORE_BITS)
        opened = groups.sparkSession.createDataFrame(
            [(blocks[i].start >> coarsest,) for i in sorted(chosen)], "opened long")  # some of the sums that were collected
        inside = F.shiftright("place", coarsest) == F.col("opened")
        closer = look(groups.join(F.broadcast(opened), inside, "left_semi"), finer)
        blocks = sorted([b for i, b in enumerate(blocks) if i not in chosen] + closer, key=lambda b: b.start)
    return []


def shard_by_bytes(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's shard and gapless slot: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Size is the UTF-8 bytes of the text plus 1; null counts as empty. Equal texts are one atomic group
    and share a shard. Groups are ordered by digest, except that groups above a sixteenth of a shard,
    of which there are at most `16 * shards`, are spaced evenly through the order, the largest
    first. Slots number the rows of a shard from 0 in a fixed but meaningless order; repeated
    rows get a slot each. Texts are read once and never shuffled.
    """
    body = text_or_empty(text)
    rows = written(
        docs.select(
            F.col(key).alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"), F.unhex(F.sha2(body, 256)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ), "shard-rows")
    by_text = written(rows.groupBy("digest").agg(F.sum("size").alias("size")), "shard-groups")
    total = by_text.agg(F.sum("size")).first()[0] or 0
    number = rows.count()
    large = (
        by_text.filter(F.col("size") * F.lit(16 * shards) > F.lit(total))
        .orderBy(F.desc("size"), "digest").collect()  # fewer than 16 * shards, as each exceeds that part of the total
    )
    alone = 0  # groups that exceed the mean of the shards left get a shard of their own
    while alone < len(large) and large[alone]["size"] * (shards - alone) > total:
        total -= large[alone]["size"]
        alone += 1
    step = (1 << PLACE_BITS) // max(1, len(large) - alone)
    spaced = docs.sparkSession.createDataFrame(
        [(bytes(r["digest"]), None if i < alone else (i - alone) * step, shards - 1 - i if i < alone else None)
         for i, r in enumerate(large)], "digest binary, given long, own int")
    hashed = F.conv(F.substring(F.hex("digest"), 1, PLACE_BITS // 4), 16, 10).cast("long")

    def placed(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(spaced), "digest", "left").withColumn("place", F.coalesce("given", hashed))

    cuts = minimax_cuts(placed(by_text).filter("own IS NULL").select("place", "size"), shards - alone)
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (F.col("place") >= F.lit(cut)).cast("int")
    buckets = task_count(docs, ROWS_PER_BUCKET, number)
    split = placed(rows).select(
        "doc_id", "size", "text_crc32", "row", F.coalesce("own", shard).alias("shard"),
        F.pmod(F.xxhash64("row"), F.lit(buckets)).alias("bucket"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = split.groupBy("shard", "bucket").agg(F.count("*").alias("n")).select(
        "shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("bucket", "shard").orderBy("doc_id", "text_crc32", "row")
    numbered = split.withColumn("at", F.row_number().over(inside) - 1)
    return numbered.join(small(offsets), ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("at") + F.col("offset")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
