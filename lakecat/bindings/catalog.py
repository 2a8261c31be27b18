"""A lake of embedded SQLite databases made from orders, and its catalog.

Orders are cut by key into databases of at most ORDERS_PER_DATABASE orders, each a
SQLite file in a binary column; what the catalog finds in them is compared with
what SQL finds in orders.
"""

from __future__ import annotations

import sqlite3
import sys
from contextlib import closing

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakecat.bindings import query, table
from lakecat.bindings.labels import rule_values
from lakecat.functions import rules
from lakecat.functions.domains import catalog_names, scored_catalog_labels
from lakecat.operators import catalog as c
from lakecat.operators.load import first_tables, non_empty
from lakecat.plans import queries as q
from lakecat.session import fresh_path, written
from lakecat.sources.copies import copy_databases
from lakecat.sources.files import discover_flat, list_files, stem
from lakecat.sources.payloads import first_source, is_mounted, land_databases
from lakecat.sources.sqlite_scan import scan_files
from lakecat.sources.sqlite_source import TARGET, Catalog, profile_databases, scan_ranges, typed, valid_databases

ORDERS_PER_DATABASE = 4096
MORE_THAN_DOUBLE = 2 ** 53 + 1
KINDS = ["shop", "bank", "school", "misc"]

LAYOUTS = {
    "customers": "c_custkey INTEGER PRIMARY KEY, label VARCHAR(20)",
    "orders": "o_orderkey INTEGER PRIMARY KEY, o_custkey INTEGER REFERENCES customers(c_custkey),"
              " o_orderstatus VARCHAR(1), o_totalprice DECIMAL(15,2), o_orderdate TIMESTAMP, \"o-priority\" TEXT",
    "levels": "o_orderkey INTEGER PRIMARY KEY, level INTEGER, measure NUMERIC",
    "returns": "a INTEGER, b TEXT, c REAL, d BLOB, e DATE",
}


def _database(orders: dict[str, list]) -> bytes:
    """One database: its orders, their customers, and levels that are numbers only for 5-LOW, where the measure is an integer
    that no double holds; elsewhere it is the price."""
    with closing(sqlite3.connect(":memory:")) as db:
        for name, columns in LAYOUTS.items():
            if name != "returns" or orders["b"][0] % 2 == 0:
                db.execute(f"CREATE TABLE {name} ({columns})")
        keys = sorted(set(orders["o_custkey"]) - {None})
        db.executemany("INSERT INTO customers VALUES (?, ?)", [(key, f"customer {key}") for key in keys])
        db.executemany("INSERT INTO orders VALUES (?, ?, ?, ?, ?, ?)", zip(
            *[orders[name] for name in (
                "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")]))
        db.executemany("INSERT INTO levels VALUES (?, ?, ?)", [
            (key, *((5, MORE_THAN_DOUBLE + 2 * key) if priority == "5-LOW" else (priority, price)))
            for key, priority, price in zip(orders["o_orderkey"], orders["o_orderpriority"], orders["o_totalprice"])])
        db.commit()
        return db.serialize()


def _one_database(orders: pa.Table) -> pa.Table:
    values = orders.to_pydict()
    return pa.table({"db_id": [values["db_id"][0]], "payload": pa.array([_database(values)], pa.binary())})


# Tasks get these functions with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def order_databases(spark: SparkSession, folder: str) -> DataFrame:
    """(db_id, path, length, payload); o_orderkey is unique, so no group outgrows its key span."""
    number = F.floor(F.col("o_orderkey") / ORDERS_PER_DATABASE)
    kind = F.element_at(F.array(*map(F.lit, KINDS)), (F.col("b") % len(KINDS)).cast("int") + 1)
    cut = (
        table(spark, folder, "orders")
        .withColumn("b", number)
        .withColumn("db_id", F.concat_ws("_", kind, F.col("b").cast("string")))
        .withColumn("o_orderdate", F.col("o_orderdate").cast("string"))
    )
    # A given number of partitions: sized by bytes, so few orders would all be built by one task.
    spread = cut.repartition(4 * spark.sparkContext.defaultParallelism, "b")
    made = spread.groupBy("b").applyInArrow(_one_database, "db_id string, payload binary")
    return made.select(
        "db_id", F.lit(None).cast("string").alias("path"), F.length("payload").cast("bigint").alias("length"), "payload")


_made: dict[tuple[str, str], tuple[Catalog, str | None]] = {}


def order_lake(spark: SparkSession, folder: str) -> tuple[Catalog, str | None]:
    """Catalog of those databases and the folder they lie in, made once per application.

    They are files where the shared folder is mounted, and stay bytes in a written table where it is not.
    """
    key = (spark.sparkContext.applicationId, folder)
    if key not in _made:
        databases, landed = order_databases(spark, folder), None
        if is_mounted(spark):
            landed = fresh_path(spark, "databases")
            files = land_databases(databases, landed)
        else:
            files = written(databases, "order_databases")
        _made[key] = profile_databases(files), landed
    return _made[key]


def order_catalog(spark: SparkSession, folder: str) -> Catalog:
    return order_lake(spark, folder)[0]


# --- the same facts in SQL ---

DB = f"""(SELECT b, {KINDS}[b % {len(KINDS)} + 1] || '_' || b AS db_id, count(*) AS n_orders,
            count(DISTINCT o_custkey) AS n_customers
     FROM (SELECT *, o_orderkey // {ORDERS_PER_DATABASE} AS b FROM orders) GROUP BY b)"""

TABLES = f"""(SELECT db_id, 'customers' AS table_name, 0 AS table_position, n_customers AS row_count FROM {DB}
     UNION ALL SELECT db_id, 'orders', 1, n_orders FROM {DB}
     UNION ALL SELECT db_id, 'levels', 2, n_orders FROM {DB}
     UNION ALL SELECT db_id, 'returns', 3, 0 FROM {DB} WHERE b % 2 = 0)"""

COLUMNS = f"""(SELECT db_id, l.* FROM {TABLES} t JOIN (VALUES
     ('customers', 'c_custkey', 'INTEGER', true, 0), ('customers', 'label', 'VARCHAR(20)', false, 1),
     ('orders', 'o_orderkey', 'INTEGER', true, 0), ('orders', 'o_custkey', 'INTEGER', false, 1),
     ('orders', 'o_orderstatus', 'VARCHAR(1)', false, 2), ('orders', 'o_totalprice', 'DECIMAL(15,2)', false, 3),
     ('orders', 'o_orderdate', 'TIMESTAMP', false, 4), ('orders', 'o-priority', 'TEXT', false, 5),
     ('levels', 'o_orderkey', 'INTEGER', true, 0), ('levels', 'level', 'INTEGER', false, 1),
     ('levels', 'measure', 'NUMERIC', false, 2),
     ('returns', 'a', 'INTEGER', false, 0), ('returns', 'b', 'TEXT', false, 1), ('returns', 'c', 'REAL', false, 2),
     ('returns', 'd', 'BLOB', false, 3), ('returns', 'e', 'DATE', false, 4)
     ) AS l(table_name, column_name, column_type, is_primary_key, column_position) ON t.table_name = l.table_name)"""

TOTALS = f"""(SELECT db_id, 3 + (b % 2 = 0)::INT AS table_count, 11 + 5 * (b % 2 = 0)::INT AS total_columns,
            1 AS total_foreign_keys, n_customers + 2 * n_orders AS total_rows,
            (3 + (b % 2 = 0)::INT) * 1.0 + (11 + 5 * (b % 2 = 0)::INT) * 0.1 + 2.0 AS complexity_score FROM {DB})"""

NAMES = f"""(SELECT db_id, 'database' AS kind, db_id AS name FROM {DB}
     UNION ALL SELECT db_id, 'table', table_name FROM {TABLES}
     UNION ALL SELECT db_id, 'column', column_name FROM {COLUMNS})"""

_KEYWORDS = rule_values(rules.SCORED_KEYWORDS)
_PATTERNS = rule_values({d: rules.SCORED_TABLE_PATTERNS.get(d, []) for d in rules.SCORED_KEYWORDS})

LABELS = f"""(SELECT db.db_id, coalesce(m.domain, 'general') AS domain, coalesce(m.score, 0)::BIGINT AS score
     FROM {DB} db LEFT JOIN (
        SELECT db_id, domain, score FROM (
            SELECT db_id, domain, place, sum(points) AS score FROM (
                SELECT db_id, domain, place, CASE kind WHEN 'database' THEN 10 WHEN 'table' THEN 3 ELSE 1 END AS points
                FROM {NAMES} JOIN {_KEYWORDS} ON contains(lower(name), word)
                UNION ALL SELECT db_id, domain, place, 5 FROM {NAMES} JOIN {_PATTERNS}
                ON kind = 'table' AND contains(lower(name), word))
            GROUP BY db_id, domain, place)
        QUALIFY row_number() OVER (PARTITION BY db_id ORDER BY score DESC, place) = 1) m
     ON db.db_id = m.db_id)"""

SCORED = f"(SELECT t.*, l.domain FROM {TOTALS} t JOIN {LABELS} l ON t.db_id = l.db_id)"


def scored_databases(spark: SparkSession, folder: str) -> DataFrame:
    """Totals, complexity and scored domain of each database."""
    profile = order_catalog(spark, folder)
    labels = scored_catalog_labels(catalog_names(profile.tables, profile.columns))
    totals = c.database_totals(profile.tables, profile.columns, profile.fks)
    return totals.join(labels.select("db_id", "domain"), "db_id")


@query("p_tables", f"SELECT * FROM {TABLES}")
def p_tables(spark, folder):
    return order_catalog(spark, folder).tables.select("db_id", "table_name", "table_position", "row_count")


@query("p_columns", f"""
    SELECT db_id || '_' || table_name || '_' || column_name AS id, db_id, table_name, column_name, column_type,
           is_primary_key, column_name = 'o_custkey' AS is_foreign_key,
           CASE WHEN column_name = 'o_custkey' THEN 'customers' END AS foreign_table,
           CASE WHEN column_name = 'o_custkey' THEN 'c_custkey' END AS foreign_column, column_position
    FROM {COLUMNS}""")
def p_columns(spark, folder):
    profile = order_catalog(spark, folder)
    return c.table_schemas(profile.columns, profile.fks)


@query("p_foreign_keys", f"""
    SELECT db_id || '_orders_o_custkey' AS id, db_id, 'orders' AS source_table, 'o_custkey' AS source_column,
           'customers' AS target_table, 'c_custkey' AS target_column FROM {DB}""")
def p_foreign_keys(spark, folder):
    return c.foreign_keys(order_catalog(spark, folder).fks)


def sizes_as_listed(spark: SparkSession, folder: str) -> DataFrame:
    """(db_id, listed): the lengths of the database files, from a listing of their folder, not from the profile."""
    landed = order_lake(spark, folder)[1]
    if not landed:
        return order_databases(spark, folder).select("db_id", F.col("length").alias("listed"))
    return list_files(spark, landed, "*", recursive=True).select(stem(F.col("path")).alias("db_id"), F.col("length").alias("listed"))


def file_of(name: str = "path") -> Column:
    """The name of a database's file; for one that lies in a column, the name it would have."""
    return F.coalesce(F.element_at(F.split(name, "/"), -1), F.concat("db_id", F.lit(".sqlite")))


@query("p_databases", f"""
    SELECT db_id, db_id AS db_name,
           ['retail', 'financial', 'education', 'general'][b % 4 + 1] AS domain,
           3 + (b % 2 = 0)::BIGINT AS num_tables, 'Benchmark database: ' || db_id AS description, true AS right_size,
           db_id || '.sqlite' AS file
    FROM {DB}""")
def p_databases(spark, folder):
    profile = order_catalog(spark, folder)
    records = c.database_records(profile.files, profile.tables).withColumnRenamed("sqlite_path", "path")
    return records.join(sizes_as_listed(spark, folder), "db_id").select(
        "db_id", "db_name", "domain", "num_tables", "description",
        (F.col("size_mb") == F.col("listed") / F.lit(1048576.0)).alias("right_size"),
        file_of().alias("file"))


@query("p_load_info", f"""
    SELECT db_id, table_name, row_count, false AS data_loaded,
           upper('LAKE_' || db_id || '_' || table_name) AS target_table_name FROM {TABLES}""")
def p_load_info(spark, folder):
    return c.table_data_info(order_catalog(spark, folder).tables).drop("load_timestamp")


@query("p_table_records", f"""
    SELECT db_id || '_' || table_name AS id, string_agg(column_name, ',' ORDER BY column_position) AS column_names,
           string_agg(column_type, ';' ORDER BY column_position) AS column_types,
           coalesce(string_agg(column_name, ',' ORDER BY column_position) FILTER (is_primary_key), '') AS primary_keys,
           CASE WHEN table_name = 'orders' THEN 'o_custkey>customers' ELSE '' END AS foreign_keys
    FROM {COLUMNS} GROUP BY db_id, table_name""")
def p_table_records(spark, folder):
    profile = order_catalog(spark, folder)
    return c.table_records(profile.columns, profile.fks).select(
        "id", F.array_join("column_names", ",").alias("column_names"),
        F.array_join("column_types", ";").alias("column_types"),
        F.array_join("primary_keys", ",").alias("primary_keys"),
        F.array_join(F.transform("foreign_keys", lambda k: F.concat_ws(">", k.source_column, k.target_table)),
                     ",").alias("foreign_keys"))


@query("p_file_listing", f"""
    SELECT db_id, count(*) AS table_count, cast(sum(row_count) AS BIGINT) AS total_rows, true AS right_size,
           db_id || '.sqlite' AS file
    FROM {TABLES} GROUP BY db_id""")
def p_file_listing(spark, folder):
    profile = order_catalog(spark, folder)
    listing = c.file_listing(profile.found, profile.tables).withColumnRenamed("file_path", "path")
    return listing.join(sizes_as_listed(spark, folder), "db_id").select(
        "db_id", "table_count", "total_rows",
        (F.col("size_mb") == F.round(F.col("listed") / F.lit(1048576.0), 2)).alias("right_size"),
        file_of().alias("file"))


@query("p_listing_totals", f"""
    SELECT count(DISTINCT db_id) AS databases, count(*) AS total_tables, cast(sum(row_count) AS BIGINT) AS total_rows,
           true AS right_size
    FROM {TABLES}""")
def p_listing_totals(spark, folder):
    profile = order_catalog(spark, folder)
    totals = c.listing_totals(c.file_listing(profile.found, profile.tables))
    megabytes = F.sum(F.round(F.col("listed") / F.lit(1048576.0), 2)).alias("megabytes")
    listed = sizes_as_listed(spark, folder).agg(megabytes, F.count("*").alias("databases"))
    return totals.join(listed, "databases").select(
        "databases", "total_tables", "total_rows", (F.abs(F.col("total_size_mb") - F.col("megabytes")) < 1e-6).alias("right_size"))


@query("s_discover_flat", f"SELECT db_id, db_id || '.sqlite' AS file, true AS right_size FROM {DB}")
def s_discover_flat(spark, folder):
    """The database files that lie directly in the folders of the landed lake."""
    landed = order_lake(spark, folder)[1]
    found = discover_flat(spark, f"{landed}/*") if landed else order_databases(spark, folder)
    return found.join(sizes_as_listed(spark, folder), "db_id").select(
        "db_id", file_of().alias("file"),
        (F.col("length") == F.col("listed")).alias("right_size"))


@query("p_db_totals", f"SELECT db_id, table_count::BIGINT AS table_count, total_columns::BIGINT AS total_columns,"
                      f" total_foreign_keys::BIGINT AS total_foreign_keys, total_rows,"
                      f" complexity_score::DOUBLE AS complexity_score FROM {TOTALS}")
def p_db_totals(spark, folder):
    profile = order_catalog(spark, folder)
    return c.database_totals(profile.tables, profile.columns, profile.fks)


DESCRIBED = "CASE domain " + " ".join(
    f"WHEN '{domain}' THEN '{text.replace(chr(39), chr(39) * 2)}'" for domain, text in rules.DOMAIN_DESCRIPTIONS.items()) + " ELSE '' END"


@query("p_domain_summary", f"""
    SELECT domain, {DESCRIBED} AS description, count(*) AS count, avg(complexity_score)::DOUBLE AS avg_complexity,
           cast(sum(table_count) AS BIGINT) AS total_tables, cast(sum(total_rows) AS BIGINT) AS total_rows
    FROM {SCORED} GROUP BY domain""")
def p_domain_summary(spark, folder):
    return c.domain_summary(scored_databases(spark, folder))


@query("p_domain_members", f"SELECT domain, db_id FROM {SCORED}")
def p_domain_members(spark, folder):
    return c.domain_members(scored_databases(spark, folder))


@query("p_complexity_range", f"""
    SELECT min(complexity_score)::DOUBLE AS min_complexity, max(complexity_score)::DOUBLE AS max_complexity,
           avg(complexity_score)::DOUBLE AS avg_complexity,
           (SELECT db_id FROM {TOTALS} ORDER BY complexity_score DESC, db_id LIMIT 1) AS most_complex,
           (SELECT db_id FROM {TOTALS} ORDER BY complexity_score, db_id LIMIT 1) AS least_complex
    FROM {TOTALS}""")
def p_complexity_range(spark, folder):
    return c.complexity_range(scored_databases(spark, folder))


@query("l_scored_catalog", f"SELECT * FROM {LABELS}")
def l_scored_catalog(spark, folder):
    profile = order_catalog(spark, folder)
    return scored_catalog_labels(catalog_names(profile.tables, profile.columns))


@query("q_schema_records", f"SELECT count(*) AS schema_records FROM {COLUMNS}")
def q_schema_records(spark, folder):
    return q.total(order_catalog(spark, folder).columns, "schema_records")


@query("q_fk_records", f"SELECT count(*) AS foreign_key_relationships FROM {DB}")
def q_fk_records(spark, folder):
    return q.total(order_catalog(spark, folder).fks, "foreign_key_relationships")


@query("s_valid_databases", f"SELECT db_id FROM {DB}")
def s_valid_databases(spark, folder):
    return valid_databases(order_catalog(spark, folder)).select("db_id")


@query("s_scan_table", f"""
    SELECT {KINDS}[o_orderkey // {ORDERS_PER_DATABASE} % {len(KINDS)} + 1] || '_' || o_orderkey // {ORDERS_PER_DATABASE} AS db_id,
           o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, o_orderstatus,
           o_totalprice::DOUBLE AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
           o_orderpriority AS priority
    FROM orders""")
def s_scan_table(spark, folder):
    """Every row and column of one table of all databases, as SQLite holds them."""
    profile, landed = order_lake(spark, folder)
    if landed:
        orders = scan_files(spark, landed, "orders")
    else:
        names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o-priority"]
        ranges = profile.ranges.filter(F.col("table_name") == "orders").withColumn(TARGET, F.col("db_id"))
        orders = typed(scan_ranges(profile.files, ranges, names, ["VARCHAR"] * 6), names, ["VARCHAR"] * 6).withColumnRenamed(
            TARGET, "db_id")
    return orders.select(
        "db_id", "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("double").alias("o_totalprice"),
        "o_orderdate", F.col("`o-priority`").alias("priority"))


@query("s_source_precedence", f"SELECT 'embedded' AS source, db_id, table_name, row_count FROM {TABLES}")
def s_source_precedence(spark, folder):
    """Of three sources the second: the first has payloads with the header of a database and no database behind it."""
    broken = table(spark, folder, "pages").select(
        F.col("page_id").cast("string").alias("db_id"), F.lit(None).cast("string").alias("path"),
        F.length("html").cast("bigint").alias("length"),
        F.concat(F.encode(F.lit("SQLite format 3"), "utf-8"), F.unhex(F.lit("00")), F.encode("html", "utf-8")).alias("payload"))
    name, profile = first_source({
        "live": broken, "none": None, "embedded": order_databases(spark, folder), "files": order_catalog(spark, folder).files})
    return profile.tables.select(F.lit(name).alias("source"), "db_id", "table_name", "row_count")


@query("k_copied", f"""
    SELECT db_id, table_name, row_count, true AS same_bytes FROM {TABLES}""")
def k_copied(spark, folder):
    """All databases copied by ranges of 64 KB to another folder, profiled there, and held against the originals byte by byte."""
    found, landed = order_catalog(spark, folder).files, order_lake(spark, folder)[1]
    if not landed:  # nothing that a path can name
        return order_catalog(spark, folder).tables.select("db_id", "table_name", "row_count", F.lit(True).alias("same_bytes"))
    copied = copy_databases(found, fresh_path(spark, "copies"), 64 << 10)

    def digests(files: DataFrame, name: str) -> DataFrame:
        folder_of = files.select(F.regexp_extract("path", r"^(.*)/[^/]+/[^/]+$", 1).alias("f")).first()["f"]
        held = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder_of)
        return held.select(stem(F.col("path")).alias("db_id"), F.sha2("content", 256).alias(name))

    same = digests(found, "one").join(digests(copied, "other"), "db_id", "full").select(
        "db_id", F.col("one").eqNullSafe(F.col("other")).alias("same_bytes"))
    return profile_databases(copied).tables.join(same, "db_id").select("db_id", "table_name", "row_count", "same_bytes")


@query("s_table_cap", f"""
    SELECT db_id, table_name, row_count FROM {TABLES} ORDER BY db_id, table_position LIMIT 10""")
def s_table_cap(spark, folder):
    return first_tables(order_catalog(spark, folder).tables, 10).select("db_id", "table_name", "row_count")


@query("w_non_empty", f"SELECT db_id, table_name FROM {TABLES} WHERE row_count > 0")
def w_non_empty(spark, folder):
    return non_empty(order_catalog(spark, folder).tables).select("db_id", "table_name")
