"""Benchmark splits: records with their position."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import partial, reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakecat.operators.sequence import with_positions
from lakecat.session import written

# Field names that hold one of these are flagged.
FLAGGED_NAMES = ["db", "database", "sqlite"]


def read_split(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               fmt: str = "parquet") -> DataFrame:
    """Records of a split with a dense 0-based `pos` in file order.

    Parquet names each row's number in its file. JSON does not, so JSON records are
    first written as Parquet with the file block they came from and their order in it.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    if fmt == "parquet":
        records = reader.parquet(path)
        numbered = records.select(
            "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
        return with_positions(numbered, ["_file"], "_row").drop("_file", "_row")
    records = reader.format(fmt).load(path)
    landed = written(records.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"),
    ), "split")
    return with_positions(landed, ["_file", "_start"], "_row").drop("_file", "_start", "_row")


def _first(n: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.slice(0, n)
        n -= batch.num_rows
        if n <= 0:
            return


def first_records(spark: SparkSession, path: str, n: int, columns: list[str] | None = None,
                  schema: T.StructType | str | None = None) -> DataFrame:
    """The first `n` records of a Parquet split with their `pos`, as `read_split` numbers them, without reading the others.

    Footers tell how many rows the first files hold: of one, two, four and so on, until there are enough. Only those files are
    scanned, a task stops after `n` rows of its part, and rows beyond the n-th go by their number in the file. Nothing is sorted.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    files = sorted(reader.parquet(path).inputFiles())
    held, taken = [], 0
    while n > 0 and taken < len(files) and sum(r["count"] for r in held) < n:
        step = files[taken:max(1, 2 * taken)]
        counts = reader.parquet(*map(unquoted, step)).groupBy(F.col("_metadata.file_path").alias("_file")).count()
        held += sorted(counts.collect(), key=lambda r: r["_file"])  # one row a file, as many as are needed and again
        taken += len(step)
    offsets, before = [], 0
    for row in held:
        if before < n:
            offsets.append((row["_file"], before, n - before))
        before += row["count"]
    records = reader.parquet(*map(unquoted, [file for file, _, _ in offsets] or files[:1]))
    records = records.select(*(columns or records.columns))
    named = records.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    places = spark.createDataFrame(offsets, "_file string, _before bigint, _left bigint")
    return (
        named.mapInArrow(partial(_first, max(n, 0)), named.schema)
        .join(F.broadcast(places), "_file").filter("_row < _left")  # no more files than records
        .withColumn("pos", F.col("_before") + F.col("_row")).drop("_file", "_row", "_before", "_left")
    )


def unquoted(uri: str) -> str:
    """A path that Spark's readers take, from a URI as they give it."""
    return unquote(uri)


def records_frame(spark: SparkSession, records: list[dict], schema: T.StructType | str) -> DataFrame:
    """A small list of records as a DataFrame (statements, rule tables)."""
    return spark.createDataFrame(records, schema)


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _shown(field: T.StructField, size: int) -> tuple[str, str]:
    """SQL for the length of a value and for its first `size` characters."""
    column = "`" + field.name.replace("`", "``") + "`"
    if isinstance(field.dataType, T.BinaryType):
        return f"length({column})", f"concat('<bytes, length ', length({column}), '>')"
    if isinstance(field.dataType, T.ArrayType):
        return f"size({column})", f"concat('<list, length ', size({column}), '>')"
    if isinstance(field.dataType, (T.MapType, T.StructType)):
        return "CAST(NULL AS INT)", f"left(to_json(struct({column})), {size})"
    return f"length(CAST({column} AS STRING))", f"left(CAST({column} AS STRING), {size})"


def _inspect(source: str, df: DataFrame, size: int) -> DataFrame:
    """One row per field: the count comes from file footers, the sample from one record."""
    entries = []
    n_rows = df.count()
    for field in df.schema.fields:
        length, text = _shown(field, size) if n_rows else ("CAST(NULL AS BIGINT)", "CAST(NULL AS STRING)")
        flagged = any(mark in field.name.lower() for mark in FLAGGED_NAMES)
        entries.append(
            f"struct({_sql_text(field.name)} AS field, '{field.dataType.simpleString()}' AS type,"
            f" {str(flagged).lower()} AS flagged, CAST({length} AS BIGINT) AS length, {text} AS sample)")
    record = df.limit(1) if n_rows else df.sparkSession.range(1)
    return record.selectExpr(
        f"{_sql_text(source)} AS source", f"{n_rows}L AS n_rows", f"inline(array({', '.join(entries)}))")


def inspect_sources(sources: dict[str, DataFrame], size: int = 100) -> DataFrame:
    """(source, n_rows, field, type, flagged, length, sample), the sample from the first record of each source.

    `sample` is cut to `size` characters, `length` is that of the whole value; both null in an empty source.
    """
    return reduce(DataFrame.unionByName, [_inspect(source, df, size) for source, df in sources.items()])


# Tasks get `_first` with its code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
