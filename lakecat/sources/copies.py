"""Copies of databases from any store to a mounted folder, by byte ranges.

SQLite opens paths, so a database on an object store is copied first. Every range of bytes is a task of its own that
writes at its place in a draft; when all ranges of a database are there, the draft is renamed. A repeated task writes the same bytes.
"""

from __future__ import annotations

import os
import re
import sys
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from lakecat.session import written
from lakecat.sources.payloads import SHARDS, with_file_ids
from lakecat.sources.sqlite_files import local_path

RANGE_BYTES, BLOCK_BYTES = 128 << 20, 4 << 20
LOG = "-wal"  # a write-ahead log beside a database belongs to it
# Schemes that Spark's readers and pyarrow's file systems spell differently.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def store_root(path: str) -> tuple[str, str] | None:
    """The root of a path's store as a URI, and the rest of the path; None for a plain path."""
    parts = re.match(r"([\w+.-]+)://([^/]*)/?(.*)", path, re.DOTALL)
    if path.startswith("file:") or parts is None:
        return None
    return f"{SCHEMES.get(parts[1], parts[1])}://{parts[2]}", parts[3]


def opened_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark lists it (not percent-encoded), and the path in it."""
    found = store_root(path)
    if found is None:
        return fs.LocalFileSystem(), local_path(path)
    where, base = fs.FileSystem.from_uri(found[0])
    return where, f"{base.rstrip('/')}/{found[1]}"


def _with_logs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The databases and the logs that lie beside them: every file with its own length."""
    for files in batches:
        rows = []
        for file in files.to_pylist():
            where, name = opened_store(file["path"])
            log = where.get_file_info(f"{name}{LOG}")
            rows.append(file | {"tail": ""})
            if log.type == fs.FileType.File and log.size:
                rows.append(file | {"tail": LOG, "length": log.size})
        yield pa.RecordBatch.from_pylist(rows, schema=files.schema.append(pa.field("tail", pa.string())))


def target_path(folder: str, file_id: str) -> str:
    return os.path.join(folder, f"{zlib.crc32(file_id.encode()) % SHARDS:02x}", f"{file_id}.sqlite")


def _copy(folder: str, run: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ranges in batches:
        copied = []
        for row in ranges.to_pylist():
            where, name = opened_store(row["path"] + row["tail"])
            target = target_path(folder, row["file_id"]) + row["tail"]
            os.makedirs(os.path.dirname(target), exist_ok=True)
            draft = os.open(f"{target}.{run}", os.O_CREAT | os.O_WRONLY)
            at, end = row["first"], min(row["first"] + row["size"], row["length"])
            try:
                with where.open_input_file(name) as source:
                    while at < end and (data := source.read_at(min(BLOCK_BYTES, end - at), at)):
                        os.pwrite(draft, data, at)
                        at += len(data)
                os.fsync(draft)
            finally:
                os.close(draft)
            copied.append(at - row["first"])
        yield pa.RecordBatch.from_arrays(
            [*(ranges.column(c) for c in ("db_id", "file_id", "tail", "length")), pa.array(copied, pa.int64())],
            ["db_id", "file_id", "tail", "length", "copied"])


def _finish(folder: str, run: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for files in batches:
        paths = []
        for row in files.to_pylist():
            target = target_path(folder, row["file_id"])
            if row["copied"] != row["length"]:
                raise OSError(f"{target}: {row['copied']} of {row['length']} bytes could be read")
            for tail in sorted(row["tails"], reverse=True):  # the log before its database
                if os.path.exists(f"{target}{tail}.{run}"):  # a repeated task finds it renamed
                    os.replace(f"{target}{tail}.{run}", f"{target}{tail}")
            if LOG not in row["tails"] and os.path.exists(f"{target}{LOG}"):
                os.remove(f"{target}{LOG}")  # of an earlier copy
            paths.append(target)
        yield pa.RecordBatch.from_arrays(
            [files.column("db_id"), pa.array(paths, pa.string()), files.column("size")], ["db_id", "path", "length"])


def copy_databases(found: DataFrame, folder: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Copy the files of `found` (db_id, path, length) below a mounted folder: (db_id, path, length).

    Paths may have any scheme that pyarrow's file systems know. Names are those of `land_databases`. A file that ends before its
    listed length is an error.
    """
    run = uuid.uuid4().hex
    named = with_file_ids(found.select("db_id", "path", "length"))
    files = written(named.mapInArrow(
        _with_logs, "db_id string, path string, length bigint, file_id string, tail string"), "copied-files")
    last = F.greatest(F.ceil(F.col("length") / range_bytes).cast("bigint") - 1, F.lit(0))
    ranges = files.withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).select(
        "db_id", "path", "length", "file_id", "tail", (F.col("i") * range_bytes).alias("first"),
        F.lit(range_bytes).cast("bigint").alias("size"))
    tasks = max(1, min(ranges.count(), 64 * found.sparkSession.sparkContext.defaultParallelism))
    copied = written(ranges.repartition(tasks).mapInArrow(
        partial(_copy, local_path(folder), run), "db_id string, file_id string, tail string, length bigint, copied bigint"),
        "copied-ranges")
    whole = copied.groupBy("db_id", "file_id", "tail").agg(F.max("length").alias("length"), F.sum("copied").alias("copied"))
    done = whole.groupBy("db_id", "file_id").agg(
        F.sum("length").alias("length"), F.sum("copied").alias("copied"), F.collect_list("tail").alias("tails"),
        F.max(F.when(F.col("tail") == "", F.col("length"))).alias("size"))
    return written(done.mapInArrow(
        partial(_finish, local_path(folder), run), "db_id string, path string, length bigint"), "copied")


# Tasks get these functions with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
