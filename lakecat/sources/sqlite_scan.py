"""One table across many SQLite files, as a data source over a plan.

The plan is made by tasks: the files are listed by Spark, each is opened once by a task, which notes its columns and cuts its
table by pages, and both are written. The data source turns the written plan into partitions; the driver opens no database.
"""

from __future__ import annotations

import sqlite3
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema

from lakecat.session import fresh_path
from lakecat.sources import sqlite_files as sq, sqlite_source
from lakecat.sources.files import list_files, stem
from lakecat.sources.sqlite_source import binary_array, even_ranges, text_array

RANGE_BYTES = 128 << 20
_COLUMN = pa.struct([("name", pa.string()), ("declared", pa.string()), ("position", pa.int32())])
_PLAN = pa.schema([
    ("path", pa.string()), ("db_id", pa.string()), ("low", pa.string()), ("high", pa.string()), ("bytes", pa.int64()),
    ("error", pa.string()), ("columns", pa.list_(_COLUMN))])


def _plan_file(file: dict, table: str, range_bytes: int) -> Iterator[dict]:
    named = {"path": file["path"], "db_id": file["db_id"]}
    try:
        with sq.open_database(file["path"]) as db:
            own = sq.find_table(db, table)
            if own is None:
                return
            columns = [{"name": name, "declared": declared, "position": i}
                       for i, (name, declared) in enumerate(sq.stored_columns(db, own))]
            ranges = even_ranges(db, file["path"], own, max(1, -(-file["length"] // range_bytes)))
            for i, (low, high) in enumerate(ranges):
                yield named | {"low": low, "high": high, "bytes": file["length"] // len(ranges),
                               "columns": [] if i else columns}
    except sqlite3.DatabaseError as error:
        yield named | {"bytes": 0, "error": str(error)}  # reading it will say so


def _plan(table: str, range_bytes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for files in batches:
        for file in files.to_pylist():
            yield pa.RecordBatch.from_pylist(list(_plan_file(file, table, range_bytes)), schema=_PLAN)


def plan_scan(spark: SparkSession, path: str, table: str, columns: list[str] | None = None, range_bytes: int = RANGE_BYTES,
              databases: list[str] | None = None, suffixes: tuple[str, ...] = (".sqlite", ".db")) -> str:
    """Write the plan of a scan of `table` in all databases at or below `path`, or in those of the given ids; returns its folder.

    Names are compared as SQLite does. The columns are those that any file has, in the order in which they first appear by
    path, or the given ones, as text; a column is binary if every file declares it so.
    """
    plan = fresh_path(spark, "scan")
    found = list_files(spark, path, "*", recursive=True)
    ends = [F.col("path").endswith(suffix) for suffix in suffixes]
    chosen = found.filter(F.exists(F.array(*ends), lambda x: x) | F.col("path").endswith(path.rstrip("/")))
    files = chosen.withColumn("db_id", stem(F.col("path")))
    if databases is not None:
        files = files.filter(F.col("db_id").isin(databases))
    tasks = 4 * spark.sparkContext.defaultParallelism
    files.repartition(tasks).mapInArrow(
        partial(_plan, table, range_bytes), from_arrow_schema(_PLAN)).write.parquet(f"{plan}/found")
    rows = spark.read.parquet(f"{plan}/found")
    rows.drop("columns").write.parquet(f"{plan}/ranges")
    held = rows.select("path", F.explode("columns").alias("c")).select(
        "path", "c.*", F.translate("c.name", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("folded"))
    first = F.struct("path", "position", "name")
    merged = held.groupBy("folded").agg(
        F.min(first).alias("first"),
        F.min(F.upper(F.coalesce("declared", F.lit(""))).contains("BLOB")).alias("binary"))
    listed = merged.select("folded", "first.*", "binary")
    if columns:
        given = spark.createDataFrame([(i, name.strip()) for i, name in enumerate(columns)], "position int, name string")
        listed = given.select("position", "name", F.lit(False).alias("binary"), F.lit("").alias("path"))
    listed.select("path", "position", "name", "binary").orderBy("path", "position").coalesce(1).write.parquet(f"{plan}/columns")
    return plan


def read_plan(folder: str, part: str) -> list[dict]:
    """A written table of a plan."""
    where, name = (fs.LocalFileSystem(), sq.local_path(folder)) if folder.startswith("file:") or "://" not in folder \
        else fs.FileSystem.from_uri(folder)
    files = [x.path for x in where.get_file_info(fs.FileSelector(f"{name}/{part}")) if x.path.endswith(".parquet")]
    return ds.dataset(files, filesystem=where, format="parquet").to_table().to_pylist() if files else []


@dataclass
class _Parts(InputPartition):
    """Ranges that one task reads: (path, db_id, low, high, error)."""

    parts: list[tuple[str, str, str | None, str | None, str | None]]


class _SqliteReader(DataSourceReader):
    # No filters are taken over: Spark keeps a reader with the filters of one query for later queries of the same DataFrame.

    def __init__(self, ranges: list[dict], table: str, names: list[str], binary: list[bool], range_bytes: int):
        self.ranges, self.table, self.names, self.binary = ranges, table, names, binary
        self.range_bytes = range_bytes

    def partitions(self):
        """Ranges packed up to `range_bytes`."""
        out, packed, held = [], [], 0
        for x in sorted(self.ranges, key=lambda x: (x["path"], x["low"] is not None)):
            if packed and held + x["bytes"] > self.range_bytes:
                out.append(_Parts(packed))
                packed, held = [], 0
            packed.append((x["path"], x["db_id"], x["low"], x["high"], x["error"]))
            held += x["bytes"]
        return out + ([_Parts(packed)] if packed else [])

    def read(self, partition: _Parts | None):
        for path, db_id, low, high, error in partition.parts if partition else []:  # none if no file was chosen
            if error:
                raise sqlite3.DatabaseError(f"{path}: {error}")
            with sq.open_database(path) as db:
                table = sq.find_table(db, self.table)
                spelt = {sq.folded(name): name for name, _ in sq.stored_columns(db, table)}
                own = [spelt.get(sq.folded(name)) for name in self.names]
                present = [name for name in own if name is not None]
                if not present:  # rows without any of the columns are rows all the same
                    yield self._batch(db_id, sq.count_and_kinds(db, table, [], low, high)[0], own, iter(()))
                    continue
                for values in sq.read_range(db, table, present, low, high):
                    yield self._batch(db_id, len(values[0]), own, iter(values))

    def _batch(self, db_id: str, rows: int, own: list[str | None], values: Iterator[tuple]) -> pa.RecordBatch:
        """One batch; a column that this file lacks is null."""
        arrays = []
        for name, is_binary in zip(own, self.binary):
            if name is None:
                arrays.append(pa.nulls(rows, pa.binary() if is_binary else pa.string()))
            else:
                arrays.append((binary_array if is_binary else text_array)(next(values)))
        return pa.RecordBatch.from_arrays([pa.array([db_id] * rows, pa.string()), *arrays], ["db_id", *self.names])


class SqliteFilesSource(DataSource):
    """One table of one or many SQLite files, with the columns that any of them has.

    Options: plan (the folder that `plan_scan` wrote), table, range_bytes (file bytes per partition, default 128 MiB).
    """

    @classmethod
    def name(cls) -> str:
        return "sqlite_files"

    def _plan(self, part: str) -> list[dict]:
        if "plan" not in self.options:
            raise ValueError("no plan: use scan_files, or plan_scan and its result as option `plan`")
        return read_plan(self.options["plan"], part)

    def schema(self) -> T.StructType:
        """db_id, then text columns, binary where declared so: what SQLite holds, before any cast."""
        columns = self._plan("columns")
        if not columns:
            raise ValueError(f"no file has a table {self.options['table']!r}")
        return T.StructType([T.StructField("db_id", T.StringType())] + [
            T.StructField(c["name"], T.BinaryType() if c["binary"] else T.StringType())
            for c in sorted(columns, key=lambda c: (c["path"], c["position"]))])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        fields = [field for field in schema.fields if field.name != "db_id"]
        binary = [isinstance(field.dataType, T.BinaryType) for field in fields]
        range_bytes = int(self.options.get("range_bytes", RANGE_BYTES))
        return _SqliteReader(self._plan("ranges"), self.options["table"], [f.name for f in fields], binary, range_bytes)


def register(spark: SparkSession) -> None:
    """Make `spark.read.format("sqlite_files")` known."""
    spark.dataSource.register(SqliteFilesSource)


def scan_files(spark: SparkSession, path: str, table: str, columns: list[str] | None = None,
               range_bytes: int = RANGE_BYTES, databases: list[str] | None = None) -> DataFrame:
    """One table of all databases at or below `path`, or of some by id: db_id, then its columns as SQLite holds them."""
    register(spark)
    plan = plan_scan(spark, path, table, columns, range_bytes, databases)
    return spark.read.format("sqlite_files").option("plan", plan).option("table", table).option(
        "range_bytes", range_bytes).load()


# Tasks get these functions with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sqlite_source)
cloudpickle.register_pickle_by_value(sys.modules[__name__])
