"""Ranges by pages, planned scans, and copies by byte ranges."""

import hashlib
import random
import sqlite3
from pathlib import Path

import pytest
from databases import make_database
from pyspark.sql import functions as F

from lakecat.sources import files as lf, sqlite_files as sq
from lakecat.sources.copies import copy_databases, store_root
from lakecat.sources.pages import even_cuts
from lakecat.sources.sqlite_scan import plan_scan, read_plan, scan_files
from lakecat.sources.sqlite_source import even_ranges, profile_databases

# Statements that make a table of two columns, and how row i of a million is filled.
TABLES = {
    "by rowid": ("CREATE TABLE t (k INTEGER PRIMARY KEY, v TEXT)", lambda i: (i, f"v{i}")),
    "sparse rowid": ("CREATE TABLE t (k INTEGER PRIMARY KEY, v TEXT)", lambda i: (i if i % 5 else 10**15 + i * 10**9, f"v{i}")),
    "integer key": ("CREATE TABLE t (k INTEGER, v TEXT, PRIMARY KEY (k)) WITHOUT ROWID", lambda i: ((i - 500) ** 3, f"v{i}")),
    "text key": ("CREATE TABLE t (k TEXT, v TEXT, PRIMARY KEY (k)) WITHOUT ROWID", lambda i: (f"{i % 7 // 5}é'{i:07d}", f"v{i}")),
    "two keys": ("CREATE TABLE t (k INTEGER, v TEXT, PRIMARY KEY (v, k)) WITHOUT ROWID", lambda i: (i, "same" if i % 3 else f"v{i}")),
    "real key": ("CREATE TABLE t (k REAL, v TEXT, PRIMARY KEY (k)) WITHOUT ROWID", lambda i: (i / 8 - 9, f"v{i}")),
    "blob key": ("CREATE TABLE t (k BLOB, v TEXT, PRIMARY KEY (k)) WITHOUT ROWID", lambda i: (b"\xff\x00" + i.to_bytes(4, "big"), f"v{i}")),
    "long keys": ("CREATE TABLE t (k TEXT, v TEXT, PRIMARY KEY (k)) WITHOUT ROWID", lambda i: (f"{i:07d}" * (300 if i % 50 == 0 else 1), "v")),
}


def counts(path, n):
    with sq.open_database(path) as db:
        ranges = even_ranges(db, path, "t", n)
        found = [sq.count_and_kinds(db, "t", [], low, high)[0] for low, high in ranges]
        return ranges, found, sq.count_rows(db, "t")


@pytest.mark.parametrize("name", sorted(TABLES))
def test_ranges_are_even(tmp_path, name):
    statement, row = TABLES[name]
    rows = [row(i) for i in range(60_000)]
    random.Random(1).shuffle(rows)
    path = make_database(tmp_path / "t.sqlite", "PRAGMA page_size = 1024", statement, rows=[("INSERT OR IGNORE INTO t VALUES (?, ?)", rows)])
    ranges, found, total = counts(path, 7)
    assert len(ranges) == 7 and sum(found) == total and max(found) < 1.7 * total / 7 and min(found) > total / 7 / 3


def test_a_million_rows_without_rowid(spark, tmp_path):
    """Every range but the last of a chunk has the wanted number of rows, and the sums agree."""
    make_database(tmp_path / "m.sqlite", "CREATE TABLE t (a TEXT, b INTEGER, c INTEGER, PRIMARY KEY (a, b)) WITHOUT ROWID",
                  rows=[("INSERT INTO t VALUES (?, ?, ?)", ((f"g{i % 3}", i, i % 11) for i in range(1_000_000)))])
    size = (tmp_path / "m.sqlite").stat().st_size
    profile = profile_databases(lf.discover_flat(spark, str(tmp_path)), whole_bytes=size // 8, range_rows=50_000, tasks=4)
    ranges = [r["row_count"] for r in profile.ranges.collect()]
    assert sum(ranges) == 1_000_000 and max(ranges) == 50_000 and ranges.count(50_000) >= 14
    assert 20 <= len(ranges) <= 20 + 9 and profile.tables.first()["row_count"] == 1_000_000
    scanned = scan_files(spark, str(tmp_path), "t", range_bytes=size // 8)
    assert scanned.rdd.getNumPartitions() >= 8
    assert tuple(scanned.agg(F.count("*"), F.sum(F.col("b").cast("long")), F.sum(F.col("c").cast("long"))).first()) == (
        1_000_000, sum(range(1_000_000)), sum(i % 11 for i in range(1_000_000)))


@pytest.mark.parametrize("statement", [
    "CREATE TABLE t (k TEXT COLLATE NOCASE, v TEXT, PRIMARY KEY (k)) WITHOUT ROWID",
    "CREATE TABLE t (k TEXT, v TEXT, PRIMARY KEY (k DESC)) WITHOUT ROWID"])
def test_other_orders_are_not_cut(tmp_path, statement):
    path = make_database(tmp_path / "t.sqlite", statement, rows=[("INSERT INTO t VALUES (?, ?)", [(f"k{i}", "v") for i in range(9000)])])
    ranges, found, _ = counts(path, 4)
    assert ranges == [(None, None)] and found == [9000]


def test_other_encodings_and_small_tables_are_not_cut(tmp_path):
    wide = make_database(tmp_path / "w.sqlite", "PRAGMA encoding = 'UTF-16'", TABLES["text key"][0],
                         rows=[("INSERT INTO t VALUES (?, ?)", [TABLES["text key"][1](i) for i in range(9000)])])
    small = make_database(tmp_path / "s.sqlite", TABLES["text key"][0], rows=[("INSERT INTO t VALUES (?, ?)", [("a", "b")])])
    for path in (wide, small):
        with sq.open_database(path) as db:
            assert even_cuts(db, path, "t", 5) == []
        assert sum(counts(path, 5)[1]) == counts(path, 5)[2]


def test_pages_in_a_log_are_not_cut(tmp_path):
    path = make_database(tmp_path / "l.sqlite", "PRAGMA journal_mode = WAL", TABLES["by rowid"][0])
    writer = sqlite3.connect(path)
    writer.execute("PRAGMA wal_autocheckpoint = 0")
    writer.executemany("INSERT INTO t VALUES (?, ?)", [(i, "v" * 50) for i in range(9000)])
    writer.commit()
    with sq.open_database(path) as db:
        assert even_cuts(db, path, "t", 5) == []
    assert sum(counts(path, 5)[1]) == 9000
    writer.close()


def test_sparse_keys_are_packed_by_bytes(spark, tmp_path):
    statement, row = TABLES["sparse rowid"]
    for name in ("a", "b"):
        make_database(tmp_path / f"{name}.sqlite", statement, rows=[("INSERT INTO t VALUES (?, ?)", [row(i) for i in range(40_000)])])
    make_database(tmp_path / "c.sqlite", "CREATE TABLE other (x)")
    (tmp_path / "t.txt").write_text("no database")
    size = (tmp_path / "a.sqlite").stat().st_size
    plan = plan_scan(spark, str(tmp_path), "T", range_bytes=size // 4)
    ranges = read_plan(plan, "ranges")
    assert len(ranges) in (8, 10) and {r["db_id"] for r in ranges} == {"a", "b"}
    sizes = scan_files(spark, str(tmp_path), "t", range_bytes=size // 4).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 8 and max(r["count"] for r in sizes) < 2 * 80_000 / 8


def test_a_filter_leaves_later_queries_alone(spark, tmp_path):
    for name, n in (("a", 1), ("c", 3)):
        make_database(tmp_path / f"{name}.sqlite", "CREATE TABLE t (x)", rows=[("INSERT INTO t VALUES (?)", [(1,)] * n)])
    df = scan_files(spark, str(tmp_path), "t")
    assert [df.count(), df.filter("db_id = 'a'").count(), df.count()] == [4, 1, 4]


def test_a_plan_tells_of_files_that_cannot_be_read(spark, tmp_path):
    make_database(tmp_path / "a.sqlite", "CREATE TABLE t (x)", rows=[("INSERT INTO t VALUES (?)", [(1,)])])
    (tmp_path / "b.sqlite").write_bytes(b"SQLite format 3\x00" + b"\x00" * 2000)
    assert scan_files(spark, str(tmp_path), "t", databases=["a"]).count() == 1
    df = scan_files(spark, str(tmp_path), "t")
    with pytest.raises(Exception, match="b.sqlite"):
        df.count()
    with pytest.raises(Exception, match="no file has a table"):
        scan_files(spark, str(tmp_path / "a.sqlite"), "missing")
    with pytest.raises(Exception, match="no plan"):
        spark.read.format("sqlite_files").option("table", "t").load(str(tmp_path)).count()


@pytest.mark.parametrize("path, root", [
    ("s3a://lake/a b/x%20.sqlite", ("s3://lake", "a b/x%20.sqlite")), ("hdfs://name:8020/x", ("hdfs://name:8020", "x")),
    ("/mnt/x", None), ("file:/mnt/a b", None), ("file:///mnt/x", None), ("gs://b/", ("gs://b", ""))])
def test_roots_of_stores(path, root):
    assert store_root(path) == root


def digest(path):
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_copies_by_ranges(spark, lake, tmp_path, scheme):
    found = lf.discover_flat(spark, str(lake)).withColumn("path", F.concat(F.lit(scheme), F.regexp_replace("path", "^file:/*", "/")))
    size = (lake / "bank_one.sqlite").stat().st_size
    copied = copy_databases(found, f"file://{tmp_path}", -(-size // 3))
    for row in copied.collect():
        origin = next(lake.glob(f"{row['db_id']}.*"))
        assert digest(row["path"]) == digest(origin) and row["length"] == origin.stat().st_size
    assert copied.count() == found.count() and not list(tmp_path.rglob("*.sqlite.*"))
    here, there = profile_databases(copied), profile_databases(found)
    for name in ("tables", "columns", "fks"):
        assert {tuple(r) for r in getattr(here, name).collect()} == {tuple(r) for r in getattr(there, name).collect()}


def test_a_log_is_copied_with_its_database(spark, tmp_path):
    (tmp_path / "from").mkdir()
    path = make_database(tmp_path / "from" / "l.sqlite", "PRAGMA journal_mode = WAL", "CREATE TABLE t (v INTEGER)")
    writer = sqlite3.connect(path)
    writer.execute("PRAGMA wal_autocheckpoint = 0")
    writer.executemany("INSERT INTO t VALUES (?)", [(i,) for i in range(50)])
    writer.commit()
    copied = copy_databases(lf.discover_flat(spark, str(tmp_path / "from")), str(tmp_path / "to"), 1000)
    assert profile_databases(copied).tables.first()["row_count"] == 50
    writer.close()


def test_a_file_that_shrank_is_an_error(spark, lake, tmp_path):
    found = lf.discover_flat(spark, str(lake)).withColumn("length", F.col("length") + 10)
    with pytest.raises(Exception, match="could be read"):
        copy_databases(found, str(tmp_path), 5000)
    assert not list(tmp_path.rglob("*.sqlite"))


def test_copies_of_empty_listings(spark, lake, tmp_path):
    assert copy_databases(lf.discover_flat(spark, str(lake)).limit(0), str(tmp_path)).count() == 0
