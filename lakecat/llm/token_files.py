"""Token ids as raw binary shards with a minimal perfect hash index.

A shard file holds the ids of consecutive documents as little-endian integers, two bytes
each if the vocabulary allows it, else four. An index file serves one bucket of keys: per
key slot a fingerprint of the key and the document's shard, first id and number of ids. A
key's slot comes from a minimal perfect hash of levels of bits, so a look-up reads one
bucket, tests a few bits, compares the fingerprint and seeks into one shard.
"""

from __future__ import annotations

import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakecat.llm.common import batches, small, text_or_empty, uncollected
from lakecat.session import fresh_path, written

#: Documents whose keys share one index bucket, on average.
KEYS_PER_BUCKET = 50_000
#: Text bytes of one shard, on average, and the rows of one key from which on their order parts them.
SHARD_BYTES, KEY_ROWS = 64 << 20, 2_000
#: Distinct white-space-free chunks whose ids a worker remembers, and as many older ones.
MOST_CHUNKS = 400_000
LONGEST_CHUNK = 64
BATCH_IDS = 500_000  # ids that a task reads back at once


PUNCTUATION = b".,;:!?#*%&$|"
#: Closing punctuation behind a letter or digit, which ends a token there.
CLOSING = re.compile(rb"(?<=[a-z0-9])[.,;:!?#*%&$|]+(?=[\x09-\x0D\x20])")


class ChunkEncoder:
    """Ids of whole texts by a `tokenizers` file, remembered per chunk between ASCII white space.

    No token crosses white space, and none of the normaliser's steps looks across it, so the ids of a
    text are those of its chunks in turn. Where the tokenizer lower-cases and cuts letters from
    punctuation, as a probe tells, an ASCII chunk is its lower-cased front and its closing punctuation, and
    new words of letters go to the tokenizer many at a time, parted by the ids that end words.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}  # what was known before `known` began anew
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, id_ in vocabulary.items():
            self.ends[id_] = token.endswith("</w>")
        one, parts = self.ids(["Abc,!? xyz"])[0], self.ids(["abc", ",!?", "xyz"])
        self.cuts = one == [id_ for part in parts for id_ in part] and all(self.ends[part[-1]] for part in parts)

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, chunks: set[bytes], width: str) -> None:
        """Remember the ids of chunks, each as a whole."""
        old = chunks.intersection(self.older)
        self.known.update((chunk, self.older[chunk]) for chunk in old)
        new = list(chunks.difference(old))
        texts = b" ".join(new).decode().split(" ") if new else []
        alone = list(zip(new, texts))
        if self.cuts:
            words = [x for x in alone if x[1].isalpha()]
            alone = [x for x in alone if not x[1].isalpha()]
            parts = [words[at:at + 512] for at in range(0, len(words), 512)]
            for part, found in zip(parts, self.ids([" ".join([text for _, text in part]) for part in parts])):
                ids = np.array(found, width)
                ends = np.flatnonzero(self.ends[ids]) + 1
                if len(ends) != len(part):  # a letter that is no single letter once it is normalised
                    alone.extend(part)
                    continue
                data, size, last = ids.tobytes(), ids.itemsize, 0
                for (word, _), end in zip(part, (ends * size).tolist()):
                    self.known[word] = data[last:end]
                    last = end
        for at in range(0, len(alone), 4096):
            part = alone[at:at + 4096]
            for (chunk, _), ids in zip(part, self.ids([text for _, text in part])):
                self.known[chunk] = np.array(ids, width).tobytes()

    def chunks(self, text: bytes) -> list[bytes]:
        """What lies between white space; lower-cased and with closing punctuation by itself where that changes no ids."""
        if not self.cuts or b"<" in text:  # a lower-cased "<|" might read as a special token
            return text.split()
        return CLOSING.sub(rb" \g<0>", text.lower()).split()

    def encode(self, texts: list[bytes | None], width: str) -> list[bytes]:
        """The ids of UTF-8 texts, as bytes of the given width."""
        if len(self.known) > MOST_CHUNKS:
            self.known, self.older = {}, self.known
        known = self.known
        split = [self.chunks(text or b"") for text in texts]
        new = set().union(*split).difference(known)
        halves = []
        if self.cuts:  # what is left of closing punctuation, behind other letters and at the end of a text
            for chunk in [c for c in new if c[-1] in PUNCTUATION and b"<" not in c]:
                front = chunk.rstrip(PUNCTUATION)
                if front and (front[-1:].isalnum() or front.decode()[-1].isalpha()):
                    halves.append((chunk, front))  # a letter or digit ends a token
        parts = {part for chunk, front in halves for part in (front, chunk[len(front):])}
        self.learn(parts.union(new).difference([chunk for chunk, _ in halves], known), width)
        for chunk, front in halves:
            known[chunk] = known[front] + known[chunk[len(front):]]
        out = [b"".join(map(known.__getitem__, chunks)) for chunks in split]
        for chunk in [c for c in new | parts if len(c) > LONGEST_CHUNK]:
            known.pop(chunk, None)
        return out


ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in ENCODERS:
        ENCODERS[path] = ChunkEncoder(path)
    return ENCODERS[path]


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it of a path that every executor reaches."""
    return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1)
                                  if path.startswith("file:") else f"file://{path}")


def put(path: str, data: bytes) -> None:
    """Write a file whole: under another name first, so that a repeated task leaves one file."""
    where, name = store(path)
    where.create_dir(name.rsplit("/", 1)[0], recursive=True)
    draft = f"{name}.{uuid.uuid4().hex}.draft"
    with where.open_output_stream(draft) as out:
        out.write(data)
    where.move(draft, name)


def get(path: str) -> bytes:
    where, name = store(path)
    with where.open_input_stream(name) as found:
        return found.read()


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser over 64-bit keys, one of many by its seed."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """A minimal perfect hash over distinct 64-bit keys.

    Level by level, the keys left are hashed into twice as many bits; a key alone at its bit stays
    there, the others go on. A key's slot is the number of set bits before its own.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = np.cumsum([0, *[int(level.sum()) for level in levels]])
        self.ranks = [np.cumsum(level) - level for level in levels]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left, levels = np.unique(keys.astype(np.uint64)), []
        while len(left):
            place = (mixed(left, len(levels)) % np.uint64(2 * len(left))).astype(np.int64)
            hits = np.bincount(place, minlength=2 * len(left))
            levels.append(hits == 1)
            left = left[hits[place] > 1]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slots of keys; -1 where a key is certainly none of those it was built from."""
        out = np.full(len(keys), -1, np.int64)
        open_rows = np.arange(len(keys))
        for i, level in enumerate(self.levels):
            place = (mixed(keys[open_rows], i) % np.uint64(len(level))).astype(np.int64)
            here = level[place]
            out[open_rows[here]] = self.before[i] + self.ranks[i][place[here]]
            open_rows = open_rows[~here]
        return out


FINGERPRINT_SEED = 977


class Index:
    """One bucket: a perfect hash and, per slot, fingerprint, shard, first id, number of ids."""

    def __init__(self, hash_: PerfectHash, slots: dict[str, np.ndarray]):
        self.hash, self.at = hash_, slots

    @classmethod
    def build(cls, keys: np.ndarray, shard: np.ndarray, first: np.ndarray, n: np.ndarray) -> Index:
        made = PerfectHash.build(keys)
        place = made.slots(keys)
        slots = {"print": (mixed(keys, FINGERPRINT_SEED) >> np.uint64(32)).astype(np.uint32),
                 "shard": shard.astype(np.int64), "first": first.astype(np.int64), "n": n.astype(np.int64)}
        order = np.empty(len(keys), np.int64)
        order[place] = np.arange(len(keys))
        return cls(made, {name: values[order] for name, values in slots.items()})

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, sizes=np.array([len(x) for x in self.hash.levels], np.int64),
                 bits=np.packbits(np.concatenate([*self.hash.levels, np.zeros(0, bool)])), **self.at)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Index:
        with np.load(io.BytesIO(data)) as held:
            sizes = held["sizes"]
            bits = np.unpackbits(held["bits"], count=int(sizes.sum())).astype(bool)
            levels = np.split(bits, np.cumsum(sizes)[:-1]) if len(sizes) else []
            return cls(PerfectHash(levels), {k: held[k] for k in ("print", "shard", "first", "n")})

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Which keys are there by slot and fingerprint, and the entries of those."""
        slot = self.hash.slots(keys)
        wanted = (mixed(keys, FINGERPRINT_SEED) >> np.uint64(32)).astype(np.uint32)
        there = slot >= 0
        there[there] = self.at["print"][slot[there]] == wanted[there]
        return there, {k: v[slot[there]] for k, v in self.at.items()}


def key_hash(column: str):
    """The 64-bit form of a document key: its hash, with null as a value."""
    return F.xxhash64(F.coalesce(F.col(column).cast("string"), F.lit("\0null")))


def write_shards(
    docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 2,
    vocabulary: int = 49_408,
) -> DataFrame:
    """Write the ids of all documents in ascending key order as shards and index files below `path`.

    Returns the written catalog: one row per document (doc_id, shard, first, n_tokens, row), `row` being its
    place among rows of its key. Rows are range-partitioned by key, null first, and by text digest
    among equal keys, so a key with very many rows is cut too; each task encodes its texts batch by batch and writes one file. Text null is empty, so only
    the end id is kept. A repeated key is indexed for its first row.
    """
    width = "<u2" if max(vocabulary, end_id + 1) <= 1 << 16 else "<u4"
    spark = docs.sparkSession
    body = text_or_empty(text)
    rows = docs.select(F.col(key).alias("doc_id"), body.alias("text"))
    sums = rows.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    copies, size = sums.agg(F.max("n"), F.sum("bytes")).first()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(least, -(-(size or 0) // SHARD_BYTES))
    tied = rows.withColumn("tie", F.xxhash64("text")).withColumn("spread", F.xxhash64(F.monotonically_increasing_id()))
    # Sampling for the ranges would read all texts for the ties, which only a hot key needs.
    by = ["doc_id", "tie", "spread"] if (copies or 0) > KEY_ROWS else ["doc_id"]
    ordered = tied.repartitionByRange(shards, *by).sortWithinPartitions("doc_id", "tie")

    def write(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        end = np.array([end_id], width).tobytes()
        size, first, target = np.dtype(width).itemsize, 0, None
        for batch in batches(found, 4 << 20):
            with uncollected():
                encoded = [ids + end for ids in encoder(tokenizer).encode(
                    batch.column("text").cast(pa.binary()).to_pylist(), width)]
            if target is None:
                where, name = store(f"{path}/shard-{shard:06d}.ids")
                where.create_dir(name.rsplit("/", 1)[0], recursive=True)
                draft = f"{name}.{uuid.uuid4().hex}.draft"
                target = where.open_output_stream(draft)
            for ids in encoded:
                target.write(ids)
            n = np.array([len(ids) // size for ids in encoded], np.int64)
            starts = first + np.cumsum(n) - n
            first += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.full(len(n), shard)), pa.array(starts), pa.array(n)],
                names=["doc_id", "shard", "first", "n_tokens"])
        if target is not None:
            target.close()
            where.move(draft, name)

    kind = rows.schema["doc_id"].dataType.simpleString()
    catalog = written(
        ordered.select("doc_id", "text").mapInArrow(write, f"doc_id {kind}, shard long, first long, n_tokens long"),
        "token-catalog")
    put(f"{path}/format.json", json.dumps({"width": width, "end_id": end_id, "shards": shards}).encode())
    keyed = (
        catalog.withColumn("key", key_hash("doc_id")).groupBy("key")
        .agg(F.min(F.struct("shard", "first", "n_tokens")).alias("at")).select("key", "at.*")
    )
    buckets = max(least, -(-catalog.count() // KEYS_PER_BUCKET))

    def index(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        keys, shard, first, n = (table[c].to_numpy() for c in ("key", "shard", "first", "n_tokens"))
        put(f"{path}/index-{bucket:06d}.npz", Index.build(keys.view(np.uint64), shard, first, n).dump())
        return pa.table({"bucket": [bucket], "keys": [len(keys)]})

    written(
        keyed.withColumn("bucket", F.pmod("key", F.lit(buckets))).groupBy("bucket")
        .applyInArrow(index, "bucket long, keys long"), "token-index")
    return catalog


def look_up(keys: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """Where the index says each key's ids lie: doc_id, shard, first, n_tokens. Keys that it lacks are left out."""
    where, name = store(path)
    buckets = len([x for x in where.get_file_info(fs.FileSelector(name)) if re.search(r"/index-\d+\.npz$", x.path)])
    kind = keys.schema[key].dataType.simpleString()

    def find(table: pa.Table) -> pa.Table:
        held = Index.load(get(f"{path}/index-{table['bucket'][0].as_py():06d}.npz"))
        there, at = held.find(table["key"].to_numpy().view(np.uint64))
        return pa.table({
            "doc_id": table["doc_id"].filter(pa.array(there)), "shard": at["shard"], "first": at["first"],
            "n_tokens": at["n"]})

    wanted = keys.select(F.col(key).alias("doc_id")).withColumn("key", key_hash("doc_id"))
    return wanted.withColumn("bucket", F.pmod("key", F.lit(max(1, buckets)))).groupBy("bucket").applyInArrow(
        find, f"doc_id {kind}, shard long, first long, n_tokens long")


def read_ids(places: DataFrame, path: str) -> DataFrame:
    """`places` (shard, first, n_tokens, ...) with `ids`, the document's ids as four-byte little-endian integers.

    Places are grouped by shard, and a shard's file is opened once per group and read by position.
    """
    layout = json.loads(get(f"{path}/format.json"))
    size = np.dtype(layout["width"]).itemsize

    def read(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, handle = None, None
        for batch in found:
            ids = np.cumsum(batch.column("n_tokens").to_numpy())
            # Documents of some `BATCH_IDS` ids go out together, however long single ones are.
            cuts = np.flatnonzero(np.diff(ids // BATCH_IDS)) + 1
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                part, out = batch.slice(start, end - start), []
                for s, f, m in zip(*(part.column(c).to_pylist() for c in ("shard", "first", "n_tokens"))):
                    if s != opened:
                        where, name = store(f"{path}/shard-{s:06d}.ids")
                        opened, handle = s, where.open_input_file(name)
                    data = handle.read_at(m * size, f * size)
                    out.append(np.frombuffer(data, layout["width"]).astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(out, pa.binary())], names=[*part.schema.names, "ids"])

    schema = ", ".join(f"`{c}` {t}" for c, t in places.dtypes) + ", ids binary"
    tasks = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        places.repartitionByRange(max(tasks, layout["shards"]), "shard", "first")
        .sortWithinPartitions("shard", "first").mapInArrow(read, schema)
    )


def shard_starts(catalog: DataFrame) -> DataFrame:
    """One row per shard: the ids of all shards before it. Shards are few: `SHARD_BYTES` of text each."""
    from pyspark.sql import Window

    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return catalog.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def round_trip(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 2) -> DataFrame:
    """Write all documents' ids, then read them back by place: doc_id, start, n_tokens, ids.

    Every row's place comes from the index, except for the later rows of a repeated key, which the
    index does not hold: their places come from the catalog. `start` counts the ids before the row.
    """
    spark = docs.sparkSession
    path = fresh_path(spark, "tokens")
    catalog = write_shards(docs, path, tokenizer, key, text, end_id)
    found = look_up(catalog.select("doc_id").distinct(), path)
    at = ["doc_id", "shard", "first", "n_tokens"]
    firsts = catalog.withColumn("key", key_hash("doc_id")).groupBy("key").agg(
        F.min(F.struct("shard", "first")).alias("at"), F.count("*").alias("copies")).filter("copies > 1")
    later = catalog.withColumn("key", key_hash("doc_id")).join(firsts, "key").filter(
        F.struct("shard", "first") > F.col("at")).select(*at)
    places = found.select(*at).unionByName(later)
    return read_ids(places, path).join(small(shard_starts(catalog)), "shard").select(
        "doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids")
