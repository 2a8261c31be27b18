"""Find database files, and name them."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakecat.sources.sqlite_files import has_header, local_path

FLAT_GLOB = "*.{sqlite,db}"
SUFFIXES = r"(?i)^.+\.(sqlite|db|sqlite3)$"
NO_SUFFIX = r"^\.?[^.]+$"
MIN_HEADER_SIZE = 1024
DIRECTORY_MARK = "database"


def list_files(spark: SparkSession, folder: str, glob: str = FLAT_GLOB, recursive: bool = False) -> DataFrame:
    """(path, length) of matching files; their content is not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(folder).select("path", "length")


def read_payloads(spark: SparkSession, folder: str, glob: str = FLAT_GLOB, recursive: bool = False) -> DataFrame:
    """(db_id, path, length, payload): whole files, for storage that is not mounted."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    files = reader.load(folder).select("path", "length", F.col("content").alias("payload"))
    named = files.withColumn("db_id", stem(F.col("path")))
    return named.join(one_file_per_id(list_files(spark, folder, glob, recursive).withColumn(
        "db_id", stem(F.col("path")))), ["db_id", "path"], "left_semi")


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(path: Column) -> Column:
    """File name without its last suffix."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def one_file_per_id(files: DataFrame) -> DataFrame:
    """(db_id, path, length): of files that share an id, the one with the smallest path."""
    chosen = files.groupBy("db_id").agg(F.min(F.struct("path", "length")).alias("f"))
    return chosen.select("db_id", "f.path", "f.length")


def shadowed_files(files: DataFrame) -> DataFrame:
    """Files that lost their id to a smaller path."""
    chosen = files.groupBy("db_id").agg(F.min("path").alias("chosen"))
    return files.join(chosen, "db_id").filter(F.col("path") != F.col("chosen"))


def discover_flat(spark: SparkSession, folder: str, glob: str = FLAT_GLOB) -> DataFrame:
    """(db_id, path, length) of the database files directly in `folder`."""
    return one_file_per_id(list_files(spark, folder, glob).withColumn("db_id", stem(F.col("path"))))


def suffixed(files: DataFrame) -> DataFrame:
    """Files with a database suffix in any case; id = stem."""
    return files.filter(file_name(F.col("path")).rlike(SUFFIXES)).withColumn("db_id", stem(F.col("path")))


def header_candidates(files: DataFrame) -> DataFrame:
    """Files without a suffix that are large enough to be a database; id = name."""
    return files.filter(
        file_name(F.col("path")).rlike(NO_SUFFIX) & (F.col("length") > MIN_HEADER_SIZE)
    ).withColumn("db_id", file_name(F.col("path")))


def in_database_directories(files: DataFrame, root: str = "") -> DataFrame:
    """`*.sqlite` files once per ancestor directory below `root` named like a database.

    The id is `<directory>_<stem>`; a file below several such directories gets several.
    """
    inside = F.split(F.expr(f"substring(path, {len(root) + 1})"), "/")
    directories = F.filter(
        F.slice(inside, F.lit(1), F.size(inside) - 1), lambda name: name.contains(DIRECTORY_MARK))
    return (
        files.filter(F.col("path").endswith(".sqlite"))
        .withColumn("_directory", F.explode(directories))
        .withColumn("db_id", F.concat_ws("_", "_directory", stem(F.col("path"))))
        .drop("_directory")
    )


def _keep_headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for files in batches:
        yield files.filter(pa.array([has_header(path.as_py()) for path in files.column("path")], pa.bool_()))


def with_header(files: DataFrame) -> DataFrame:
    """Files that start with the SQLite magic; executors read 16 bytes of each."""
    return files.mapInArrow(_keep_headers, files.schema)


def discover_recursive(spark: SparkSession, folder: str) -> DataFrame:
    """(db_id, path, length) of every database below `folder`, by suffix, header or directory."""
    files = list_files(spark, folder, "*", recursive=True)
    found = suffixed(files).unionByName(with_header(header_candidates(files)))
    return one_file_per_id(found.unionByName(in_database_directories(files, _uri(folder))))


def _uri(folder: str) -> str:
    """`folder` the way file listings spell it."""
    if "://" in folder and not folder.startswith("file:"):
        return folder.rstrip("/")
    return f"file:{local_path(folder).rstrip('/')}"


def merged(*found: DataFrame) -> DataFrame:
    """Union of (db_id, path, length) listings; for one id the later listing wins."""
    ranked = None
    for priority, files in enumerate(found):
        one = files.select("db_id", "path", "length").withColumn("priority", F.lit(priority))
        ranked = one if ranked is None else ranked.unionByName(one)
    last = ranked.groupBy("db_id").agg(F.max_by(F.struct("path", "length"), F.struct("priority", "path")).alias("f"))
    return last.select("db_id", "f.path", "f.length")


# Tasks get `_keep_headers` with its code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
