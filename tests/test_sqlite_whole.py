"""SQLite reads that lose nothing: logs, odd columns, damage, names, and values as they are stored."""

import datetime
import sqlite3
from decimal import Decimal

import pytest
from databases import make_database
from pyspark.sql import functions as F

from lakecat.operators.execution import query_only
from lakecat.operators.load import LoadOptions, latest_state, load_tables, read_table
from lakecat.session import fresh_path
from lakecat.sources import files as lf
from lakecat.sources.payloads import land_databases
from lakecat.sources.sqlite_scan import scan_files
from lakecat.sources.sqlite_source import profile_databases


def rows_of(df):
    return {tuple(row) for row in df.collect()}


def test_rows_in_the_write_ahead_log_count(spark, tmp_path):
    path = make_database(tmp_path / "logged.sqlite", "PRAGMA journal_mode = WAL", "CREATE TABLE t (v INTEGER)")
    with sqlite3.connect(path) as writer:
        writer.execute("PRAGMA wal_autocheckpoint = 0")
        writer.executemany("INSERT INTO t VALUES (?)", [(i,) for i in range(5)])
        writer.commit()
        assert (tmp_path / "logged.sqlite-wal").stat().st_size > 0
        assert rows_of(profile_databases(lf.discover_flat(spark, str(tmp_path))).tables.select("row_count")) == {(5,)}
    writer.close()


def test_files_that_differ_in_columns_and_spelling(spark, tmp_path):
    make_database(tmp_path / "a.sqlite", "CREATE TABLE t (id INTEGER, v TEXT)", rows=[("INSERT INTO t VALUES (?, ?)", [(1, "x")])])
    make_database(tmp_path / "b.sqlite", "CREATE TABLE T (ID INTEGER, extra TEXT)",
                  rows=[("INSERT INTO T VALUES (?, ?)", [(2, "y")])])
    make_database(tmp_path / "c.sqlite", "CREATE TABLE other (z)")
    df = scan_files(spark, str(tmp_path), "t")
    assert df.columns == ["db_id", "id", "v", "extra"] and df.rdd.getNumPartitions() == 1
    assert rows_of(df) == {("a", "1", "x", None), ("b", "2", None, "y")}
    assert rows_of(scan_files(spark, str(tmp_path), "t", ["extra"])) == {("a", None), ("b", "y")}


def test_generated_columns_are_scanned(spark, tmp_path):
    make_database(tmp_path / "g.sqlite", "CREATE TABLE t (a INTEGER, twice INTEGER GENERATED ALWAYS AS (a * 2) STORED)",
                  rows=[("INSERT INTO t (a) VALUES (?)", [(3,)])])
    profile = profile_databases(lf.discover_flat(spark, str(tmp_path)))
    assert [r[0] for r in profile.columns.select("column_name").collect()] == ["a"]
    options = LoadOptions(fresh_path(spark, "loaded"))
    log = load_tables(profile, options, fresh_path(spark, "log"))
    assert rows_of(read_table(spark, options.root, log, "LAKE_G_T").select("A", "TWICE")) == {(3, 6)}


@pytest.fixture
def damaged(tmp_path):
    """Two tables, the pages of one of which are overwritten."""
    path = tmp_path / "d.sqlite"
    make_database(path, "CREATE TABLE bad (v TEXT)", "CREATE TABLE good (v TEXT)",
                  rows=[(f"INSERT INTO {t} VALUES (?)", [(t + "x" * 500,) for _ in range(200)]) for t in ("bad", "good")])
    data = bytearray(path.read_bytes())
    size = int.from_bytes(data[16:18], "big")
    for page in range(1, len(data) // size):
        if b"badxxx" in data[page * size:(page + 1) * size] and b"goodx" not in data[page * size:(page + 1) * size]:
            data[page * size:page * size + 100] = b"\xff" * 100
    path.write_bytes(data)
    return tmp_path


def test_damage_stays_with_its_table_at_any_size(spark, damaged):
    seen = []
    for whole_bytes in (1 << 30, 4096):
        profile = profile_databases(lf.discover_flat(spark, str(damaged)), whole_bytes=whole_bytes, range_rows=50)
        assert rows_of(profile.tables.select("table_name", "row_count")) == {("good", 200), ("bad", None)}
        ranges = profile.ranges.groupBy("table_name").agg(F.sum("row_count"))
        seen.append([rows_of(df) for df in (
            profile.tables, profile.columns, profile.stored, profile.files, ranges, profile.errors.select("db_id", "table_name"))])
    assert seen[0] == seen[1] and seen[0][-1] == {("d", "bad")}


def test_ids_that_clean_to_one_name_land_apart(spark, tmp_path):
    ids = {"x y": 1, "xy": 2, "!!": 3, "plain": 4}
    rows = []
    for db_id, n in ids.items():
        path = make_database(tmp_path / f"{n}.tmp", "CREATE TABLE t (v)", rows=[("INSERT INTO t VALUES (?)", [(i,) for i in range(n)])])
        with open(path, "rb") as file:
            rows.append((db_id, None, 1, file.read()))
    df = spark.createDataFrame(rows, "db_id string, path string, length long, payload binary")
    (tmp_path / "landed").mkdir()
    landed = land_databases(df, str(tmp_path / "landed"))
    assert landed.select("path").distinct().count() == 4
    assert rows_of(profile_databases(landed).tables.select("db_id", "row_count")) == set(ids.items())


def test_values_are_loaded_as_they_are_stored(spark, tmp_path):
    make_database(
        tmp_path / "v.sqlite",
        "CREATE TABLE t (n NUMERIC(10,5), d DECIMAL, p POINT, b BIGINT, day DATE, at DATETIME, i INTEGER, x BLOB, none INT)",
        rows=[("INSERT INTO t VALUES (?, ?, ?, ?, ?, ?, ?, ?, ?)", [
            (1.23456, 9.87654, "1,2", 7.5, 1700000000, 1700000000123, 1 << 40, b"\x00\x01", None),
            (0.001, 2, "3,4", 1, 1, 2, None, b"z", None)])])
    options = LoadOptions(fresh_path(spark, "loaded"))
    log = load_tables(profile_databases(lf.discover_flat(spark, str(tmp_path))), options, fresh_path(spark, "log"))
    assert latest_state(log).select("cast_failures").first()[0] == 0
    rows = read_table(spark, options.root, log, "LAKE_V_T").orderBy("DAY").collect()
    assert tuple(rows[1]) == (1.23456, 9.87654, "1,2", 7.5, 1700000000, 1700000000123, 1 << 40, bytearray(b"\x00\x01"), None)
    assert tuple(rows[0]) == (0.001, 2.0, "3,4", 1.0, 1, 2, None, bytearray(b"z"), None)


BIG = [2 ** 53 + 1, 2 ** 63 - 1, -(2 ** 63)]


@pytest.mark.parametrize("values, kind, want", [
    ([1, 2 ** 53, -(2 ** 53), 1.5], "double", [1.0, 2.0 ** 53, -(2.0 ** 53), 1.5]),
    ([*BIG, 1], "bigint", [*BIG, 1]),
    ([*BIG, 1.5, -0.125, 0.1], "decimal(38,3)", [*map(Decimal, BIG), Decimal("1.5"), Decimal("-0.125"), Decimal("0.1")]),
    ([BIG[0], 1e15], "decimal(38,1)", [Decimal(BIG[0]), Decimal(10) ** 15]),
    ([BIG[1], 1e300], "string", [str(BIG[1]), "1e+300"]),
    ([BIG[1], 1e-30], "string", [str(BIG[1]), "1e-30"]),
    ([BIG[1], float("inf")], "string", [str(BIG[1]), "inf"]),
    ([BIG[0], "007", 1.5], "string", [str(BIG[0]), "007", "1.5"]),
    ([1, "12"], "string", ["1", "12"]),
    (["2024-01-05", "2024-02-06"], "string", ["2024-01-05", "2024-02-06"]),
    ([BIG[0], b"\x01"], "string", [str(BIG[0]), "X'01'"]),
    ([1.5, None, 2.5], "double", [1.5, None, 2.5]),
    ([None, None], "string", [None, None]),
])
@pytest.mark.parametrize("whole_bytes", [1 << 30, 1])
def test_mixtures_lose_nothing(spark, tmp_path, values, kind, want, whole_bytes):
    """Also where the kinds of values lie in different ranges of a table."""
    make_database(tmp_path / "m.sqlite", "CREATE TABLE t (id INTEGER PRIMARY KEY, v)",
                  rows=[("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))])
    options = LoadOptions(fresh_path(spark, "loaded"))
    profile = profile_databases(lf.discover_flat(spark, str(tmp_path)), whole_bytes=whole_bytes, range_rows=1, tasks=2)
    log = load_tables(profile, options, fresh_path(spark, "log"))
    assert [tuple(r) for r in log.select("ok", "cast_failures").collect()] == [(True, 0)]
    rows = read_table(spark, options.root, log, "LAKE_M_T").orderBy("ID").select("V")
    assert rows.dtypes == [("V", kind)] and [r["V"] for r in rows.collect()] == want


def test_large_integers_in_embedded_databases(spark, tmp_path):
    path = make_database(tmp_path / "e.tmp", "CREATE TABLE t (v)", rows=[("INSERT INTO t VALUES (?)", [(BIG[1],), (0.25,)])])
    with open(path, "rb") as file:
        rows = [("e", None, 1, file.read())]
    profile = profile_databases(spark.createDataFrame(rows, "db_id string, path string, length long, payload binary"))
    options = LoadOptions(fresh_path(spark, "loaded"))
    log = load_tables(profile, options, fresh_path(spark, "log"))
    assert rows_of(read_table(spark, options.root, log, "LAKE_E_T")) == {(Decimal(BIG[1]),), (Decimal("0.25"),)}


def test_declared_types_keep_a_cast(spark, tmp_path):
    make_database(tmp_path / "s.sqlite", "CREATE TABLE t (day DATE, v VARCHAR(5))",
                  rows=[("INSERT INTO t VALUES (?, ?)", [("2024-05-06", "a")])])
    options = LoadOptions(fresh_path(spark, "loaded"), types="sized")
    log = load_tables(profile_databases(lf.discover_flat(spark, str(tmp_path))), options, fresh_path(spark, "log"))
    assert rows_of(read_table(spark, options.root, log, "LAKE_S_T")) == {(datetime.date(2024, 5, 6), "a")}


@pytest.mark.parametrize("statement, rows", [
    ("SELECT 1; -- done", 1), ("/* why */ (SELECT 1 AS a) UNION ALL (SELECT 2)", 2), ("WITH x AS (SELECT 1) SELECT * FROM x", 1),
    ("VALUES (1), (2), (3)", 3)])
def test_statements_run_alone(spark, statement, rows):
    assert query_only(spark, statement).count() == rows


@pytest.mark.parametrize("statement", [
    "SELECT 1) AS a, (SELECT 2", "DROP VIEW nothing", "SELECT 1; SELECT 2", "CREATE TABLE x AS SELECT 1", "SELECT missing",
    "WITH x AS (SELECT 1 AS a) INSERT INTO nowhere SELECT * FROM x", ""])
def test_other_statements_are_refused(spark, statement):
    with pytest.raises(Exception):
        query_only(spark, statement)
