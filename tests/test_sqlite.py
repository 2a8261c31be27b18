import pytest
from databases import make_database
from pyspark.sql import functions as F

from lakecat.operators.catalog import file_listing, table_schemas
from lakecat.operators.execution import run_stored_queries
from lakecat.operators.load import LoadOptions, latest_state, load_tables, publish_tables, read_table
from lakecat.session import fresh_path
from lakecat.sources import files as lf
from lakecat.sources.payloads import land_databases
from lakecat.sources.sqlite_scan import scan_files
from lakecat.sources.sqlite_source import profile_databases


@pytest.fixture(scope="module")
def catalog(spark, lake):
    return profile_databases(lf.discover_flat(spark, str(lake)))


@pytest.fixture(scope="module")
def split_catalog(spark, lake):
    """The same files, treated as large: every table is cut into ranges."""
    return profile_databases(lf.discover_flat(spark, str(lake)), whole_bytes=20_000, range_rows=100)


def rows_of(df):
    return {tuple(row) for row in df.collect()}


def test_only_readable_databases_with_tables_are_valid(catalog):
    assert rows_of(catalog.files.select("db_id")) == {("bank_one",), ("school-two",), ("collide",)}
    assert rows_of(catalog.errors.select("db_id")) == {("header_only",)}


def test_unreadable_files_are_listed_with_zeros(catalog):
    listing = file_listing(catalog.found, catalog.tables)
    zeros = {r.db_id for r in listing.collect() if r.table_count == r.total_rows == 0}
    assert zeros == {"header_only", "no_tables"} and listing.count() == 5


def test_tables_and_counts(catalog, split_catalog):
    expected = {
        ("bank_one", "customers", 1000), ("bank_one", "accounts", 3000), ("school-two", "order", 2),
        ("school-two", "sqlite_sequence", 1), ("school-two", "nothing_in", 0), ("school-two", "pairs", 200),
        ("school-two", "child", 0), ("school-two", "mixed", 3), ("collide", "t", 1),
    }
    for profile in (catalog, split_catalog):
        assert rows_of(profile.tables.select("db_id", "table_name", "row_count")) == expected


def test_ranges_hold_few_rows_each(split_catalog):
    sizes = split_catalog.ranges.filter("table_name = 'accounts'").agg(
        F.max("row_count").alias("most"), F.count("*").alias("n"), F.sum("row_count").alias("rows")).first()
    assert sizes.most <= 100 and sizes.n >= 30 and sizes.rows == 3000


def test_columns_and_keys(catalog):
    pairs = catalog.columns.filter("table_name = 'pairs'").orderBy("column_position")
    assert [(r.column_name, r.column_type, r.is_primary_key, r.column_position) for r in pairs.collect()] == [
        ("a", "INTEGER", True, 0), ("b", "TEXT", True, 1), ("c", "REAL", False, 2)]
    assert rows_of(catalog.fks.select("source_table", "source_column", "target_table", "target_column")) == {
        ("accounts", "customer_id", "customers", "id"), ("child", "x", "parent", None)}


def test_schema_records_mark_foreign_keys(catalog):
    marked = table_schemas(catalog.columns, catalog.fks)
    assert marked.count() == catalog.columns.count()
    assert rows_of(marked.filter("is_foreign_key").select("id", "foreign_table", "foreign_column")) == {
        ("bank_one_accounts_customer_id", "customers", "id"), ("school-two_child_x", "parent", None)}


@pytest.mark.parametrize("which", ["catalog", "split_catalog"])
def test_load_all(spark, request, which):
    profile = request.getfixturevalue(which)
    options = LoadOptions(fresh_path(spark, "loaded"))
    log = load_tables(profile, options, fresh_path(spark, "log"))
    state = {(r.db_id, r.table_name): r for r in latest_state(log).collect()}
    assert {key for key, r in state.items() if not r.ok} == {("collide", "t")}
    assert "collide" in state["collide", "t"].error
    assert state["school-two", "mixed"].cast_failures == 0  # a column of numbers and words is text
    assert state["school-two", "nothing_in"].ok and state["school-two", "nothing_in"].row_count == 0

    accounts = read_table(spark, options.root, log, "LAKE_BANK_ONE_ACCOUNTS")
    assert accounts.columns == ["ID", "CUSTOMER_ID", "BALANCE"]
    assert dict(accounts.dtypes)["BALANCE"] == "double"
    totals = accounts.agg(F.count("*"), F.sum("ID"), F.sum("BALANCE")).first()
    assert tuple(totals) == (3000, sum(i * 7 for i in range(3000)), sum(i / 4 for i in range(3000)))

    order = read_table(spark, options.root, log, "LAKE_SCHOOL-TWO_ORDER")
    assert rows_of(order) == {(1, "a", "b"), (2, None, "ü")}
    pairs = read_table(spark, options.root, log, "LAKE_SCHOOL-TWO_PAIRS")
    assert rows_of(pairs) == {(i % 10, f"it's {i}", i / 3) for i in range(200)}
    assert read_table(spark, options.root, log, "LAKE_SCHOOL-TWO_NOTHING_IN").count() == 0
    mixed = read_table(spark, options.root, log, "LAKE_SCHOOL-TWO_MIXED").select("N", "RAW")
    assert {(n, raw and bytes(raw)) for n, raw in rows_of(mixed)} == {("1", b"\x00\x01"), ("many", b"x"), (None, None)}


def test_a_repeated_load_replaces_and_its_tables_answer_sql(spark, split_catalog):
    options = LoadOptions(fresh_path(spark, "loaded"), prefix="again")
    log_path = fresh_path(spark, "log")
    for _ in range(2):
        log = load_tables(split_catalog, options, log_path)
    assert log.count() == 2 * split_catalog.tables.count()
    assert publish_tables(spark, options.root, log) == split_catalog.tables.count() - 1
    questions = spark.createDataFrame([
        ("sum", "SELECT SUM(balance) FROM AGAIN_BANK_ONE_ACCOUNTS"),
        ("all", "SELECT * FROM AGAIN_BANK_ONE_ACCOUNTS a JOIN AGAIN_BANK_ONE_CUSTOMERS c ON a.customer_id = c.id"),
        ("some", 'SELECT name FROM AGAIN_BANK_ONE_CUSTOMERS WHERE name IN ("n1", "n2")'),
        ("none", "SELECT * FROM `AGAIN_SCHOOL-TWO_ORDER` WHERE false"),
        ("empty", "SELECT * FROM `AGAIN_SCHOOL-TWO_NOTHING_IN` LIMIT 0"),
    ], "id string, sql_query string")
    results = run_stored_queries(questions, fresh_path(spark, "results"))
    assert rows_of(results.select("question_id", "result_rows")) == {
        ("sum", 1), ("all", 3000), ("some", 2), ("none", 0), ("empty", 0)}


def test_odd_file_names(spark, tmp_path):
    odd = tmp_path / "a database" / "x y#1%20?"
    odd.mkdir(parents=True)
    make_database(odd / "é q#%.sqlite", "CREATE TABLE t (x INTEGER)", rows=[("INSERT INTO t VALUES (?)", [(1,)])])
    for folder in (str(tmp_path), f"file://{tmp_path}/"):
        found = lf.discover_recursive(spark, folder)
        assert rows_of(found.select("db_id")) == {("é q#%",), ("a database_é q#%",)}
    options = LoadOptions(fresh_path(spark, "loaded"))
    log = load_tables(profile_databases(found), options, fresh_path(spark, "log"))
    assert rows_of(read_table(spark, options.root, log, "LAKE_É Q#%_T")) == {(1,)}


def test_tables_with_one_target_name_do_not_mix(spark, tmp_path):
    make_database(tmp_path / "a.db", "CREATE TABLE b_c (x INTEGER)", rows=[("INSERT INTO b_c VALUES (?)", [(1,)])])
    make_database(tmp_path / "a_b.db", "CREATE TABLE c (x INTEGER)", rows=[("INSERT INTO c VALUES (?)", [(2,)])])
    options = LoadOptions(fresh_path(spark, "loaded"))
    log = load_tables(profile_databases(lf.discover_flat(spark, str(tmp_path))), options, fresh_path(spark, "log"))
    assert rows_of(log.select("db_id", "ok")) == {("a", True), ("a_b", False)}
    assert rows_of(read_table(spark, options.root, log, "LAKE_A_B_C")) == {(1,)}


def test_table_cap_counts_successes_only(spark, catalog):
    options = LoadOptions(fresh_path(spark, "loaded"))
    log = load_tables(catalog, options, fresh_path(spark, "log"), max_tables=4)
    entries = [(r.db_id, r.table_name, r.ok) for r in log.orderBy("db_id", "table_name").collect()]
    assert entries == [
        ("bank_one", "accounts", True), ("bank_one", "customers", True), ("collide", "t", False),
        ("school-two", "order", True), ("school-two", "sqlite_sequence", True)]


def test_embedded_payloads_give_the_same_catalog_and_rows(spark, lake, catalog):
    embedded = profile_databases(lf.read_payloads(spark, str(lake)))
    for name in ("tables", "columns", "fks"):
        here, there = getattr(embedded, name), getattr(catalog, name)
        assert rows_of(here.select(*there.columns)) == rows_of(there)
    options = LoadOptions(fresh_path(spark, "loaded"))
    log = load_tables(embedded, options, fresh_path(spark, "log"))
    assert read_table(spark, options.root, log, "LAKE_BANK_ONE_CUSTOMERS").count() == 1000


def test_landed_payloads_are_read_by_path(spark, lake, catalog, tmp_path):
    embedded = lf.read_payloads(spark, str(lake))
    landed = profile_databases(land_databases(embedded, str(tmp_path)), whole_bytes=20_000, range_rows=100)
    assert rows_of(landed.tables) == rows_of(catalog.tables)
    assert landed.ranges.filter("path NOT LIKE '%.sqlite'").count() == 0


@pytest.mark.parametrize("range_bytes", [10_000, 1 << 30])
def test_data_source(spark, lake, range_bytes):
    df = scan_files(spark, str(lake / "bank_one.sqlite"), "accounts", range_bytes=range_bytes)
    assert df.columns == ["db_id", "id", "customer_id", "balance"]
    assert df.rdd.getNumPartitions() > 1 or range_bytes > 10_000
    assert df.filter("db_id = 'bank_one'").agg(F.count("*"), F.sum(F.col("id").cast("long"))).first() == (
        3000, sum(i * 7 for i in range(3000)))
    assert df.filter("db_id = 'other'").count() == 0
