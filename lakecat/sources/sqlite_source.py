"""SQLite databases as DataFrames: catalog profiling and scans of tables.

The unit of work is a key range of one table of one file. Ranges are rows of a
DataFrame, so listing, counting and reading all run as Spark tasks; the driver
sees neither table data nor the list of ranges.
"""

from __future__ import annotations

import sqlite3
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import from_arrow_schema

from lakecat.functions.typemap import spark_type
from lakecat.session import written
from lakecat.sources import pages, sqlite_files as sq
from lakecat.sources.pages import even_cuts

WHOLE_FILE_BYTES = 256 << 20  # smaller files are counted in the listing pass, as one range per table
RANGE_ROWS = 2_000_000
TASK_ROWS, TASK_RANGES = 500_000, 500  # what a task scans where ranges are smaller
TARGET = "_lake_table"  # names the target table of a scanned row
FAILURES = "_cast_failures"

_PROFILE = pa.schema([
    ("db_id", pa.string()), ("path", pa.string()), ("kind", pa.string()), ("table_name", pa.string()),
    ("table_position", pa.int32()), ("row_count", pa.int64()), ("position", pa.int32()),
    ("column_name", pa.string()), ("column_type", pa.string()), ("is_primary_key", pa.bool_()),
    ("target_table", pa.string()), ("target_column", pa.string()), ("kinds", pa.list_(pa.int32())),
    ("filled", pa.list_(pa.int64())), ("error", pa.string()),
])
_RANGES = pa.schema([
    ("db_id", pa.string()), ("path", pa.string()), ("table_name", pa.string()), ("low", pa.string()),
    ("high", pa.string()), ("row_count", pa.int64()), ("kinds", pa.list_(pa.int32())),
    ("filled", pa.list_(pa.int64())), ("error", pa.string()),
])


@dataclass
class Catalog:
    """Profiled databases; every member is read from a written table."""

    found: DataFrame  # db_id, path, length of all files, readable or not
    files: DataFrame  # db_id, path, length [, payload]: databases that open and have a table
    tables: DataFrame  # db_id, table_name, table_position, row_count
    columns: DataFrame  # db_id, table_name, column_name, column_type, is_primary_key, column_position
    stored: DataFrame  # db_id, table_name, column_name, column_type, column_position, kinds, filled (values), whole, scale: what a scan brings
    fks: DataFrame  # db_id, source_table, source_column, target_table, target_column, seq
    ranges: DataFrame  # db_id, path, table_name, low, high, row_count
    errors: DataFrame  # db_id, path, table_name, error


def _database_rows(file: dict, whole_bytes: int) -> Iterator[dict]:
    """What a file holds. A table that cannot be read is an error of its own beside the others."""
    payload = file.get("payload")
    counted = payload is not None or file["length"] < whole_bytes
    with sq.open_database(file["path"], payload) as db:
        for at, table in enumerate(sq.table_names(db)):
            named = {"db_id": file["db_id"], "path": file["path"], "table_name": table}
            rows, kinds, filled = None, None, None
            try:
                scanned = sq.stored_columns(db, table)
                for position, (column, declared, is_key) in enumerate(sq.table_columns(db, table)):
                    yield named | {"kind": "column", "position": position, "column_name": column,
                                   "column_type": declared, "is_primary_key": is_key}
                for position, (column, declared) in enumerate(scanned):
                    yield named | {"kind": "stored", "position": position, "column_name": column, "column_type": declared}
                for seq, (source, target, target_column) in enumerate(sq.foreign_keys(db, table)):
                    yield named | {"kind": "fk", "position": seq, "column_name": source,
                                   "target_table": target, "target_column": target_column}
                if counted:
                    rows, kinds, filled = sq.count_and_kinds(db, table, [name for name, _ in scanned])
            except sqlite3.Error as error:
                yield named | {"kind": "error", "error": str(error)}
            yield named | {"kind": "table", "table_position": at, "row_count": rows, "kinds": kinds, "filled": filled}


def _profile(whole_bytes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for files in batches:
        for i in range(files.num_rows):
            file = files.slice(i, 1).to_pylist()[0]
            try:
                rows = list(_database_rows(file, whole_bytes))
            except sqlite3.Error as error:
                rows = [{"db_id": file["db_id"], "path": file["path"], "kind": "error", "error": str(error)}]
            yield pa.RecordBatch.from_pylist(rows, schema=_PROFILE)


def even_ranges(db: sqlite3.Connection, path: str, table: str, n: int) -> list[tuple[str | None, str | None]]:
    """Up to `n` ranges of equal numbers of pages, or of equal rowid width where the pages cannot tell."""
    cuts = even_cuts(db, path, table, n)
    if not cuts:
        return sq.even_ranges(db, table, n)
    ends = [None, *cuts, None]
    return list(zip(ends, ends[1:]))


def _counted(chunk: dict, rows: int) -> Iterator[dict]:
    named = {name: chunk[name] for name in ("db_id", "path", "table_name")}
    try:
        with sq.open_database(chunk["path"]) as db:
            columns = [name for name, _ in sq.stored_columns(db, chunk["table_name"])]
            even = even_ranges(db, chunk["path"], chunk["table_name"], chunk["n"])
            for low, high in even[chunk["i"]:chunk["i"] + 1]:
                for start, end, _ in sq.counted_ranges(db, chunk["table_name"], low, high, rows):
                    n, kinds, filled = sq.count_and_kinds(db, chunk["table_name"], columns, start, end)
                    yield named | {"low": start, "high": end, "row_count": n, "kinds": kinds, "filled": filled}
    except sqlite3.Error as error:
        yield named | {"error": str(error)}


def _count_ranges(rows: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunks in batches:
        for chunk in chunks.to_pylist():
            yield pa.RecordBatch.from_pylist(list(_counted(chunk, rows)), schema=_RANGES)


_PLACES = pa.schema([
    ("db_id", pa.string()), ("table_name", pa.string()), ("column_name", pa.string()), ("whole", pa.int32()), ("scale", pa.int32())])


def _decimal_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            with sq.open_database(row["path"], row["payload"]) as db:
                for part in row["parts"]:
                    named = {name: part[name] for name in ("table_name", "column_name")}
                    whole, scale = sq.decimal_places(db, part["table_name"], part["column_name"], part["low"], part["high"])
                    yield pa.RecordBatch.from_pylist(
                        [named | {"db_id": row["db_id"], "whole": whole, "scale": scale}], schema=_PLACES)


def decimal_places(files: DataFrame, ranges: DataFrame, stored: DataFrame) -> DataFrame:
    """(db_id, table_name, column_name, whole, scale): digits before and after the point, of columns with integers beyond
    2 ** 53 beside reals, which neither longs nor doubles hold. Only the ranges of their tables are read."""
    both = F.lit(sq.STORED["real"] | sq.LARGE)
    mixed = stored.filter(F.col("kinds").bitwiseAND(both) == both).select("db_id", "table_name", "column_name")
    part = F.struct("table_name", "column_name", "low", "high")
    parts = ranges.filter("row_count > 0").join(mixed, ["db_id", "table_name"]).select("db_id", "path", part.alias("part"))
    if "payload" in files.columns:
        work = files.join(parts.groupBy("db_id").agg(F.collect_list("part").alias("parts")), "db_id").select(
            "db_id", "path", "payload", "parts")
    else:
        work = parts.select("db_id", "path", F.lit(None).cast("binary").alias("payload"), F.array("part").alias("parts"))
        # A given number of partitions: sized by bytes, so small ranges would all be read by one task.
        work = work.repartition(4 * files.sparkSession.sparkContext.defaultParallelism)
    return work.mapInArrow(_decimal_places, from_arrow_schema(_PLACES)).groupBy(
        "db_id", "table_name", "column_name").agg(F.max("whole").alias("whole"), F.max("scale").alias("scale"))


def profile_databases(files: DataFrame, whole_bytes: int = WHOLE_FILE_BYTES, range_rows: int = RANGE_ROWS,
                      tasks: int | None = None) -> Catalog:
    """Profile every database of `files` (db_id, path, length [, payload]).

    One pass opens each file and lists tables, columns and foreign keys; it counts
    the rows of small files too. Tables of large files are counted by a second pass
    over chunks of equal numbers of pages, which also cuts them into ranges of equal row counts.
    """
    spark = files.sparkSession
    tasks = tasks or 4 * spark.sparkContext.defaultParallelism
    embedded = "payload" in files.columns
    if not embedded:
        files = written(files.select("db_id", "path", "length"), "files")
    spread = files if embedded else files.repartition(tasks)
    profile = written(spread.mapInArrow(partial(_profile, whole_bytes), from_arrow_schema(_PROFILE)), "profile")
    of_kind = {kind: profile.filter(F.col("kind") == kind) for kind in ("table", "column", "stored", "fk", "error")}

    listed = of_kind["table"].select("db_id", "path", "table_name", "table_position", "row_count", "kinds", "filled")
    whole = listed.filter(F.col("row_count").isNotNull()).select(
        "db_id", "path", "table_name", F.lit(None).cast("string").alias("low"),
        F.lit(None).cast("string").alias("high"), "row_count", "kinds", "filled", F.lit(None).cast("string").alias("error"))
    if embedded:
        ranges = whole
    else:
        chunks = (
            listed.filter(F.col("row_count").isNull())
            .join(files.select("db_id", "path", "length").filter(F.col("length") >= whole_bytes), ["db_id", "path"])
            .withColumn("n", F.ceil(F.col("length") / F.lit(whole_bytes)).cast("int"))
            .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
            .select("db_id", "path", "table_name", "n", "i")
        )
        counted = chunks.repartition(tasks).mapInArrow(
            partial(_count_ranges, range_rows), from_arrow_schema(_RANGES))
        ranges = written(whole.unionByName(counted), "ranges")

    faults = of_kind["error"].select("db_id", "path", "table_name", "error").unionByName(
        ranges.filter(F.col("error").isNotNull()).select("db_id", "path", "table_name", "error"))
    broken = faults.groupBy("db_id", "path", "table_name").agg(F.min("error").alias("error"))
    # A table with an unreadable part has no count and no ranges, whatever its other parts hold.
    good = ranges.join(
        broken.filter(F.col("table_name").isNotNull()).select("db_id", "table_name"), ["db_id", "table_name"], "left_anti")
    counts = good.groupBy("db_id", "table_name").agg(F.sum("row_count").alias("row_count"))
    held = good.select("db_id", "table_name", F.posexplode(F.arrays_zip("kinds", "filled")).alias("position", "of")).groupBy(
        "db_id", "table_name", "position").agg(F.bit_or("of.kinds").alias("kinds"), F.sum("of.filled").alias("filled"))
    stored = of_kind["stored"].select("db_id", "table_name", "column_name", "column_type", "position").join(
        held, ["db_id", "table_name", "position"], "left").select(
        "db_id", "table_name", "column_name", "column_type", F.col("position").alias("column_position"),
        F.coalesce("kinds", F.lit(0)).alias("kinds"), F.coalesce("filled", F.lit(0)).alias("filled"))
    readable = (
        files.join(listed.select("db_id", "path").distinct(), ["db_id", "path"], "left_semi")
        if not embedded else files.join(listed.select("db_id").distinct(), "db_id", "left_semi"))
    places = written(decimal_places(readable, good, stored), "decimal-places")
    return Catalog(
        found=files.select("db_id", "path", "length"),
        files=readable,
        tables=listed.drop("row_count", "kinds", "filled").join(counts, ["db_id", "table_name"], "left").select(
            "db_id", "table_name", "table_position", "row_count"),
        columns=of_kind["column"].select(
            "db_id", "table_name", "column_name", "column_type", "is_primary_key",
            F.col("position").alias("column_position")),
        stored=stored.join(places, ["db_id", "table_name", "column_name"], "left"),
        fks=of_kind["fk"].select(
            "db_id", F.col("table_name").alias("source_table"), F.col("column_name").alias("source_column"),
            "target_table", "target_column", F.col("position").alias("seq")),
        ranges=good.drop("error", "kinds", "filled"),
        errors=broken,
    )


def valid_databases(profile: Catalog) -> DataFrame:
    """Databases that open and hold at least one table."""
    return profile.files


def text_array(values: tuple) -> pa.Array:
    """Text of every value; a batch of text only is taken as it is."""
    if set(map(type, values)) <= {str, type(None)}:
        return pa.array(values, pa.string())
    return pa.array([sq.as_text(value) for value in values], pa.string())


def binary_array(values: tuple) -> pa.Array:
    if set(map(type, values)) <= {bytes, type(None)}:
        return pa.array(values, pa.binary())
    return pa.array([sq.as_bytes(value) for value in values], pa.binary())


def _number_arrays(values: tuple, kind: type, arrow_type: pa.DataType) -> list[pa.Array]:
    """Values stored as `kind`, and beside them the text of those that are not."""
    if set(map(type, values)) <= {kind, type(None)}:
        return [pa.array(values, arrow_type), pa.nulls(len(values), pa.string())]
    return [
        pa.array([value if type(value) is kind else None for value in values], arrow_type),
        pa.array([None if type(value) is kind else sq.as_text(value) for value in values], pa.string()),
    ]


def _arrays(values: tuple, kind: str) -> list[pa.Array]:
    if kind == "long":
        return _number_arrays(values, int, pa.int64())
    if kind == "double":
        return _number_arrays(values, float, pa.float64())
    return [binary_array(values) if kind == "binary" else text_array(values)]


def _kind(target: str) -> str:
    """How the values of a target type leave SQLite: as stored where the cast is free."""
    simple = {T.LongType(): "long", T.DoubleType(): "double", T.BinaryType(): "binary"}
    return simple.get(spark_type(target), "text")


def scan_schema(targets: list[str]) -> T.StructType:
    """TARGET, then v0, v1, ...; numbers bring the text of other values as t0, t1, ..."""
    types = {"long": T.LongType(), "double": T.DoubleType(), "binary": T.BinaryType(), "text": T.StringType()}
    fields = [T.StructField(TARGET, T.StringType())]
    for i, kind in enumerate(map(_kind, targets)):
        fields.append(T.StructField(f"v{i}", types[kind]))
        if kind in ("long", "double"):
            fields.append(T.StructField(f"t{i}", T.StringType()))
    return T.StructType(fields)


def _scan(names: list[str], kinds: list[str], columns: list[str],
          batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            with sq.open_database(row["path"], row["payload"]) as db:
                for part in row["parts"]:
                    for values in sq.read_range(db, part["table_name"], names, part["low"], part["high"]):
                        arrays = [array for column, kind in zip(values, kinds) for array in _arrays(column, kind)]
                        tag = pa.array([part[TARGET]] * len(arrays[0]), pa.string())
                        yield pa.RecordBatch.from_arrays([tag, *arrays], columns)


def scan_tasks(ranges: DataFrame) -> int:
    """Tasks for a scan of `ranges`: small ones share a task, so that what tasks report grows with rows, not with databases."""
    rows = F.sum("row_count") if "row_count" in ranges.columns else F.count("*") * RANGE_ROWS
    held = ranges.agg(F.count("*").alias("n"), F.coalesce(rows, F.lit(0)).alias("rows")).first()
    least = max(4 * ranges.sparkSession.sparkContext.defaultParallelism, -(-held["rows"] // TASK_ROWS), -(-held["n"] // TASK_RANGES))
    return max(1, min(held["n"], least))


def scan_ranges(files: DataFrame, ranges: DataFrame, names: list[str], targets: list[str],
                tasks: int | None = None) -> DataFrame:
    """Rows of every range, as `scan_schema` says; all tables share names and target types.

    `ranges` has (db_id, path, table_name, low, high, TARGET), and row_count where it is known. A range is
    read by one task, which reads several small ones; embedded databases go once to a task, with all their tables.
    """
    part = F.struct("table_name", "low", "high", TARGET)
    if "payload" in files.columns:
        per_file = ranges.groupBy("db_id").agg(F.collect_list(part).alias("parts"))
        work = files.join(per_file, "db_id").select("path", "payload", "parts")
    else:
        tasks = tasks or scan_tasks(ranges)
        work = ranges.select("path", F.lit(None).cast("binary").alias("payload"), F.array(part).alias("parts"))
        work = work.repartition(tasks)
    schema = scan_schema(targets)
    return work.mapInArrow(partial(_scan, names, list(map(_kind, targets)), schema.names), schema)


def typed(scanned: DataFrame, names: list[str], targets: list[str],
          rename: Callable[[list[str]], list[str]] = list) -> DataFrame:
    """Cast scanned columns to their target types; values that do not fit become null.

    Adds FAILURES, the number of non-null values of the row that did not fit.
    """
    cast, failed = [], F.lit(0)
    for i, (name, target) in enumerate(zip(rename(names), targets)):
        value, kind, data_type = F.col(f"v{i}"), _kind(target), spark_type(target)
        if kind in ("long", "double"):
            text = F.col(f"t{i}")
            parsed = text.try_cast(data_type)
            failed = failed + (text.isNotNull() & parsed.isNull()).cast("int")
            value = F.coalesce(value, parsed)
        elif kind == "text" and not isinstance(data_type, T.StringType):
            parsed = value.try_cast(data_type)
            failed = failed + (value.isNotNull() & parsed.isNull()).cast("int")
            value = parsed
        cast.append(value.alias(name))
    return scanned.select(TARGET, *cast, failed.alias(FAILURES))


# Tasks get these functions with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sq)
cloudpickle.register_pickle_by_value(pages)
cloudpickle.register_pickle_by_value(sys.modules[__name__])
