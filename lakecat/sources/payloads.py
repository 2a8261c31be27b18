"""Databases embedded in benchmark records."""

from __future__ import annotations

import hashlib
import os
import sys
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakecat.functions.naming import clean_file_id, colliding_ids
from lakecat.session import shared_folder, written
from lakecat.sources.sqlite_files import local_path
from lakecat.sources.sqlite_source import Catalog, profile_databases, valid_databases

# Record fields that may hold a database, in order of preference.
PAYLOAD_FIELDS = ["database", "db_file", "sqlite_file", "db_path"]
LIVE_PREFIX = "livesql_"
MAGIC = b"SQLite format 3"


def payload_field(records: DataFrame) -> str | None:
    return next((name for name in PAYLOAD_FIELDS if name in records.columns), None)


def decode_payloads(records: DataFrame, id_prefix: str = "") -> DataFrame:
    """(db_id, payload, kind) of records that carry a database.

    kind is `bytes`, `base64`, `url` (kept as text bytes, not fetched) or `unknown`.
    Text that starts with http is a URL even where it would decode.
    """
    named = records.filter(F.col("db_id") != "")
    field = payload_field(records)
    if field is None:
        return named.limit(0).select(
            "db_id", F.lit(None).cast("binary").alias("payload"), F.lit(None).cast("string").alias("kind"))
    value = F.col(field)
    if isinstance(records.schema[field].dataType, T.BinaryType):
        payload, kind = value, F.lit("bytes")
    else:
        decoded = F.try_to_binary(value, F.lit("base64"))
        is_url = value.startswith("http")
        payload = F.when(is_url, F.encode(value, "utf-8")).otherwise(decoded)
        kind = F.when(is_url, "url").when(decoded.isNotNull(), "base64").otherwise("unknown")
    present = F.length(value) > 0
    return named.filter(present).select(
        F.concat(F.lit(id_prefix), F.col("db_id")).alias("db_id"), payload.alias("payload"), kind.alias("kind"))


def live_payloads(splits: dict[str, DataFrame]) -> DataFrame | None:
    """Byte payloads of every split whose name holds `sqlite`, ids prefixed."""
    out = None
    for name, records in splits.items():
        if "sqlite" not in name.lower() or "database" not in records.columns:
            continue
        one = decode_payloads(records.select("db_id", "database"), LIVE_PREFIX)
        one = one.filter(F.col("kind") == "bytes")
        out = one if out is None else out.unionByName(one)
    return out


def databases_in(decoded: DataFrame) -> DataFrame:
    """(db_id, path, length, payload) of payloads that start with the SQLite magic."""
    return decoded.filter(
        F.col("kind").isin("bytes", "base64") & F.startswith(F.col("payload"), F.lit(MAGIC))
    ).select(
        "db_id", F.lit(None).cast("string").alias("path"),
        F.length("payload").cast("bigint").alias("length"), "payload",
    )


SHARDS = 256  # folders the landed files spread over
DRAFTS = "_drafts"  # below the folder of the landed files; Spark's listings pass over it


def _write_drafts(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every payload as a file named by the hash of its whole id."""
    for found in batches:
        paths = []
        for db_id, payload in zip(found.column("db_id"), found.column("payload")):
            name = hashlib.sha256(db_id.as_py().encode()).hexdigest()
            shard = os.path.join(folder, DRAFTS, name[:2])
            os.makedirs(shard, exist_ok=True)
            path = os.path.join(shard, name)
            draft = f"{path}.{uuid.uuid4().hex}"
            with open(draft, "wb") as file:
                file.write(payload.as_buffer())
            os.replace(draft, path)  # a repeated task ends with the same file
            paths.append(path)
        yield pa.RecordBatch.from_arrays(
            [found.column("db_id"), found.column("length"), pa.array(paths, pa.string())], ["db_id", "length", "draft"])


def _name_files(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drafts under the names of their databases."""
    for found in batches:
        paths = []
        for name, draft in zip(found.column("file_id").to_pylist(), found.column("draft").to_pylist()):
            shard = os.path.join(folder, f"{zlib.crc32(name.encode()) % SHARDS:02x}")
            os.makedirs(shard, exist_ok=True)
            path = os.path.join(shard, f"{name}.sqlite")
            try:
                os.replace(draft, path)
            except FileNotFoundError:
                if not os.path.exists(path):  # a task before this one has named it
                    raise
            paths.append(path)
        yield pa.RecordBatch.from_arrays(
            [found.column("db_id"), pa.array(paths, pa.string()), found.column("length")], ["db_id", "path", "length"])


def with_file_ids(found: DataFrame) -> DataFrame:
    """`found` with `file_id`, the file name of each db_id."""
    columns = found.columns
    clashing = colliding_ids(found).select("file_id", F.lit(True).alias("clashes"))
    own = F.when(F.col("clashes") | (F.col("file_id") == ""), F.concat_ws(
        "-", F.nullif("file_id", F.lit("")), F.lower(F.hex(F.xxhash64("db_id"))))).otherwise(F.col("file_id"))
    return found.withColumn("file_id", clean_file_id(F.col("db_id"))).join(clashing, "file_id", "left").select(
        *columns, own.alias("file_id"))


def land_databases(found: DataFrame, folder: str) -> DataFrame:
    """Write embedded databases as files below a mounted shared folder: (db_id, path, length).

    Afterwards they are read by path and key range, like files that were there before. Ids that clean to
    one name, or to nothing, get the hash of the whole id behind it, so that no file replaces another.
    """
    spark, folder = found.sparkSession, local_path(folder)
    # Payloads go straight to files, so that they are made once and do not travel: only ids meet to tell which of them clash.
    drafts = written(found.select("db_id", "length", "payload").mapInArrow(
        partial(_write_drafts, folder), "db_id string, length bigint, draft string"), "drafts")
    named = with_file_ids(drafts).select("db_id", "file_id", "length", "draft")
    spread = named.repartition(4 * spark.sparkContext.defaultParallelism)
    return written(spread.mapInArrow(partial(_name_files, folder), "db_id string, path string, length bigint"), "landed")


def is_mounted(spark: SparkSession) -> bool:
    """Whether all executors see the shared folder as a plain folder.

    Set `spark.lakecat.mounted` where that is not told by its path: a path without a scheme, or with `file:`, is mounted.
    """
    told = spark.conf.get("spark.lakecat.mounted", None)
    if told is not None:
        return told.lower() == "true"
    folder = shared_folder(spark)
    return folder.startswith("file:") or "://" not in folder


def first_source(sources: dict[str, DataFrame | None], **options) -> tuple[str, Catalog] | None:
    """The name and the profile of the first source with a database that opens and has a table; None if no source has one.

    `sources` are listings (db_id, path, length [, payload]) by name, in order of preference. A source is profiled when those before it
    have turned out to hold no database, and what that found is handed on, so the chosen one is opened once.
    """
    for name, found in sources.items():
        if found is not None:
            profile = profile_databases(found, **options)
            if valid_databases(profile).limit(1).count():
                return name, profile
    return None


# Tasks get these functions with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
