"""Loads, load state, checks, reports and stored queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakecat.bindings import TABLES as TABLE_NAMES, query, table
from lakecat.bindings.catalog import COLUMNS, DB, MORE_THAN_DOUBLE, SCORED, TABLES, order_catalog, order_databases, scored_databases
from lakecat.bindings.sources import DEV_SQL, dev_records
from lakecat.bindings.views import document_questions
from lakecat.operators import catalog as c
from lakecat.operators.checks import duplicate_keys, key_check, load_checks, metadata_key_checks
from lakecat.operators.execution import run_stored_queries
from lakecat.operators.load import (
    LoadOptions, landing_name, latest_state, load_tables, loaded_counts, mark_loaded, read_metadata, replace_contents,
    table_path, write_metadata)
from lakecat.operators.questions import normalise_questions
from lakecat.operators.report import report_parts, write_report
from lakecat.schemas import QUESTIONS
from lakecat.session import fresh_path
from lakecat.sources.payloads import land_databases
from lakecat.sources.splits import records_frame
from lakecat.sources.sqlite_source import TARGET, profile_databases

_logs: dict[tuple[str, str, str], DataFrame] = {}
order_roots: dict[tuple[str, str, str], str] = {}


def order_log(spark: SparkSession, folder: str, types: str = "stored") -> DataFrame:
    """Log of the load of every table of the order databases, once per application; declared types keep their names."""
    key = (spark.sparkContext.applicationId, folder, types)
    if key not in _logs:
        options = LoadOptions(fresh_path(spark, "loaded"), types=types, normalise=types == "stored")
        order_roots[key] = options.root
        _logs[key] = load_tables(order_catalog(spark, folder), options, fresh_path(spark, "load_log"))
    return _logs[key]


@query("k_bulk_load", f"""
    SELECT db_id, table_name, upper('LAKE_' || db_id || '_' || table_name) AS target_table_name, row_count,
           0 AS cast_failures, true AS ok
    FROM {TABLES}""")
def k_bulk_load(spark, folder):
    return latest_state(order_log(spark, folder)).select(
        "db_id", "table_name", "target_table_name", "row_count", "cast_failures", "ok")


def loaded(spark: SparkSession, folder: str, table_name: str, columns: dict[str, Column], types: str = "stored") -> DataFrame:
    """Columns of one table of all order databases as it was loaded, with its target name.

    Tables that store other kinds of values have other types, so each layout is read by itself.
    """
    log = latest_state(order_log(spark, folder, types)).filter(
        (F.col("table_name") == table_name) & F.col("ok") & (F.col("row_count") > 0))
    root = order_roots[spark.sparkContext.applicationId, folder, types]
    layouts = log.groupBy("signature").agg(F.collect_list("target_table_name").alias("targets"))
    parts = [
        spark.read.option("basePath", root).parquet(*[table_path(root, target) for target in layout["targets"]]).select(
            F.col(TARGET).alias("target"), *[column.alias(name) for name, column in columns.items()])
        for layout in layouts.toLocalIterator()]
    return reduce(DataFrame.unionByName, parts)


VALUES = {"key": "string", "label": "string", "status": "string", "price": "double", "day": "string", "priority": "string",
          "customer": "bigint", "measure": "decimal(38,2)"}
NO_VALUES = ", ".join(f"NULL::{kind.replace('string', 'VARCHAR')} AS {name}" for name, kind in list(VALUES.items())[2:])


def values_sql(level: str) -> str:
    """Every value of every loaded table; `level` is what becomes of a level that is no number."""
    return f"""
    SELECT * REPLACE (measure::VARCHAR AS measure) FROM (
        SELECT 'LAKE_' || upper(d.db_id) || '_CUSTOMERS' AS target, c.o_custkey::VARCHAR AS key, 'customer ' || c.o_custkey AS label,
               {NO_VALUES}
        FROM (SELECT DISTINCT o_orderkey // 4096 AS b, o_custkey FROM orders WHERE o_custkey IS NOT NULL) c JOIN {DB} d ON c.b = d.b
        UNION ALL
        SELECT 'LAKE_' || upper(d.db_id) || '_ORDERS', o_orderkey::VARCHAR, NULL, o_orderstatus, o_totalprice,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), o_orderpriority, o_custkey, NULL
        FROM orders o JOIN {DB} d ON o.o_orderkey // 4096 = d.b
        UNION ALL
        SELECT 'LAKE_' || upper(d.db_id) || '_LEVELS', o_orderkey::VARCHAR,
               CASE WHEN o_orderpriority = '5-LOW' THEN '5' ELSE {level} END, NULL, NULL, NULL, NULL, NULL,
               CASE WHEN o_orderpriority = '5-LOW' THEN CAST({MORE_THAN_DOUBLE} + 2 * o_orderkey AS DECIMAL(38,2))
               ELSE CAST(o_totalprice AS DECIMAL(38,2)) END
        FROM orders o JOIN {DB} d ON o.o_orderkey // 4096 = d.b)"""


def loaded_values(spark: SparkSession, folder: str, types: str, priority: str) -> DataFrame:
    def shaped(table_name: str, **columns) -> DataFrame:
        named = {n: (F.col(columns[n]) if n in columns else F.lit(None)).cast(t) for n, t in VALUES.items()}
        return loaded(spark, folder, table_name, named, types)

    rows = shaped("customers", key="C_CUSTKEY", label="LABEL").unionByName(shaped(
        "orders", key="O_ORDERKEY", status="O_ORDERSTATUS", price="O_TOTALPRICE", day="O_ORDERDATE", priority=priority,
        customer="O_CUSTKEY")).unionByName(shaped("levels", key="O_ORDERKEY", label="LEVEL", measure="MEASURE"))
    return rows.withColumn("measure", F.col("measure").cast("string"))


@query("k_loaded_values", values_sql("o_orderpriority"))
def k_loaded_values(spark, folder):
    """Every value of every loaded table, as it lies in the files."""
    return loaded_values(spark, folder, "stored", "O_PRIORITY")


@query("k_inferred_load", f"""
    SELECT 'LAKE_' || upper(db_id) || '_ORDERS' AS target, o_orderkey AS O_ORDERKEY, o_custkey AS O_CUSTKEY,
           o_orderstatus AS O_ORDERSTATUS, o_totalprice AS O_TOTALPRICE,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS O_ORDERDATE, o_orderpriority AS O_PRIORITY
    FROM orders o JOIN {DB} d ON o.o_orderkey // 4096 = d.b""")
def k_inferred_load(spark, folder):
    """Names, types and values that the load found for one table: no cast here."""
    names = ["O_ORDERKEY", "O_CUSTKEY", "O_ORDERSTATUS", "O_TOTALPRICE", "O_ORDERDATE", "O_PRIORITY"]
    return loaded(spark, folder, "orders", {name: F.col(name) for name in names})


@query("k_typed_load", values_sql("NULL"))
def k_typed_load(spark, folder):
    """All tables by their declared types: a level that is no number becomes null."""
    return loaded_values(spark, folder, "sized", "`O-PRIORITY`")


@query("k_cast_failures", f"""
    SELECT t.db_id, table_name, row_count, CASE WHEN table_name = 'levels' THEN words ELSE 0 END AS cast_failures
    FROM {TABLES} t JOIN {DB} d ON t.db_id = d.db_id JOIN (
        SELECT o_orderkey // 4096 AS b, count(*) FILTER (o_orderpriority <> '5-LOW') AS words FROM orders GROUP BY b) w
    ON d.b = w.b""")
def k_cast_failures(spark, folder):
    return latest_state(order_log(spark, folder, "sized")).select("db_id", "table_name", "row_count", "cast_failures")


@query("k_load_state", f"""
    SELECT db_id, table_name, row_count, true AS data_loaded,
           upper('LAKE_' || db_id || '_' || table_name) AS target_table_name, true AS stamped FROM {TABLES}""")
def k_load_state(spark, folder):
    log = order_log(spark, folder)
    info = c.table_data_info(order_catalog(spark, folder).tables)
    marked = mark_loaded(mark_loaded(info, log), log)
    return marked.withColumn("stamped", F.col("load_timestamp").isNotNull()).drop("load_timestamp")


@query("k_loaded_counts", f"""
    SELECT db_id, count(*) AS tables_loaded, cast(sum(row_count) AS BIGINT) AS rows_loaded FROM {TABLES} GROUP BY db_id""")
def k_loaded_counts(spark, folder):
    return loaded_counts(order_log(spark, folder))


@query("k_capped_load", f"""
    SELECT db_id, table_name, row_count, true AS ok FROM {TABLES} ORDER BY db_id, table_position LIMIT 5""")
def k_capped_load(spark, folder):
    log = load_tables(
        order_catalog(spark, folder), LoadOptions(fresh_path(spark, "loaded")), fresh_path(spark, "load_log"), 5)
    return log.select("db_id", "table_name", "row_count", "ok")


@query("k_landing_names", rf"""
    SELECT db_id, table_name, regexp_replace(db_id, '[^\p{{L}}\p{{N}}_-]', '', 'g') || '/' || table_name AS landing
    FROM {TABLES}""")
def k_landing_names(spark, folder):
    return order_catalog(spark, folder).tables.select(
        "db_id", "table_name", landing_name(F.col("db_id"), F.col("table_name")).alias("landing"))


def metadata(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The catalog, the questions and the load state, written as metadata tables and read back."""
    profile = order_catalog(spark, folder)
    paths = write_metadata(spark, fresh_path(spark, "metadata"), {
        "questions": normalise_questions(dev_records(spark, folder)),
        "databases": c.database_records(profile.files, profile.tables),
        "tables": c.table_records(profile.columns, profile.fks),
        "table_schemas": c.table_schemas(profile.columns, profile.fks),
        "foreign_keys": c.foreign_keys(profile.fks),
        "table_data_info": mark_loaded(c.table_data_info(profile.tables), order_log(spark, folder)),
    })
    return read_metadata(spark, paths)


KEYED_COUNTS = f"""
    (SELECT 'questions' AS table_name, count(*) AS n FROM documents UNION ALL SELECT 'databases', count(*) FROM {DB}
     UNION ALL SELECT 'tables', count(*) FROM {TABLES} UNION ALL SELECT 'table_schemas', count(*) FROM {COLUMNS}
     UNION ALL SELECT 'foreign_keys', count(*) FROM {DB})"""


# Per metadata table its key and what is compared of it, as Spark expressions and as SQL over the test tables.
CONTENTS = {
    "questions": ("id", "db_id, question, sql_query, difficulty, domain, question_id_original", f"""
        SELECT id, concat_ws('|', db_id, question, sql_query, difficulty, domain, question_id_original) FROM ({DEV_SQL})"""),
    "databases": ("db_id", "db_name, domain, num_tables, description", f"""
        SELECT db_id, concat_ws('|', db_id, ['retail', 'financial', 'education', 'general'][b % 4 + 1], 3 + (b % 2 = 0)::BIGINT,
            'Benchmark database: ' || db_id) FROM {DB}"""),
    "tables": ("id", "db_id, table_name, array_join(column_names, ','), array_join(column_types, ';'), array_join(primary_keys, ',')", f"""
        SELECT db_id || '_' || table_name, concat_ws('|', db_id, table_name, string_agg(column_name, ',' ORDER BY column_position),
            string_agg(column_type, ';' ORDER BY column_position),
            coalesce(string_agg(column_name, ',' ORDER BY column_position) FILTER (is_primary_key), ''))
        FROM {COLUMNS} GROUP BY db_id, table_name"""),
    "table_schemas": ("id", "column_type, is_primary_key, is_foreign_key, foreign_table, column_position", f"""
        SELECT db_id || '_' || table_name || '_' || column_name, concat_ws('|', column_type, is_primary_key,
            column_name = 'o_custkey', CASE WHEN column_name = 'o_custkey' THEN 'customers' END, column_position) FROM {COLUMNS}"""),
    "foreign_keys": ("id", "source_table, source_column, target_table, target_column", f"""
        SELECT db_id || '_orders_o_custkey', 'orders|o_custkey|customers|c_custkey' FROM {DB}"""),
    "table_data_info": ("concat_ws('.', db_id, table_name)", "row_count, data_loaded, target_table_name", f"""
        SELECT db_id || '.' || table_name, concat_ws('|', row_count, true, upper('LAKE_' || db_id || '_' || table_name)) FROM {TABLES}"""),
    "execution_results": ("question_id", "result_rows", "SELECT '', '' FROM orders WHERE false"),
    "test_summary": ("''", "''", "SELECT '', '' FROM orders WHERE false"),
}


@query("k_metadata_tables", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, key, content, true AS stamped FROM ({sql}) AS t(key, content)"
    for name, (_, _, sql) in CONTENTS.items()))
def k_metadata_tables(spark, folder):
    """Every row of every metadata table as it was written."""
    return reduce(DataFrame.unionByName, [
        rows.selectExpr(f"'{name}' AS table_name", f"{CONTENTS[name][0]} AS key", f"concat_ws('|', {CONTENTS[name][1]}) AS content",
                        "created_at IS NOT NULL AS stamped")
        for name, rows in metadata(spark, folder).items()])


@query("k_metadata_keys", f"""
    SELECT table_name, n AS distinct_keys, 0::BIGINT AS duplicate_keys, 0::BIGINT AS null_key_rows FROM {KEYED_COUNTS}""")
def k_metadata_keys(spark, folder):
    return metadata_key_checks(metadata(spark, folder))


@query("k_landed", f"""
    SELECT db_id || tail AS db_id, table_name, row_count FROM {TABLES}, (SELECT unnest(['', ' ', '!']) AS tail)""")
def k_landed(spark, folder):
    """Databases under three ids each that clean to one name, landed and read back."""
    ids = F.array("db_id", F.concat("db_id", F.lit(" ")), F.concat("db_id", F.lit("!")))
    found = order_databases(spark, folder).withColumn("db_id", F.explode(ids))
    return profile_databases(land_databases(found, fresh_path(spark, "landed"))).tables.select("db_id", "table_name", "row_count")


@query("k_replace_questions", f"""
    SELECT id, db_id, length(question) AS question_chars, domain, true AS stamped FROM ({DEV_SQL})""")
def k_replace_questions(spark, folder):
    path = fresh_path(spark, "questions")
    replace_contents(normalise_questions(dev_records(spark, folder)), path, QUESTIONS)
    return spark.read.schema(QUESTIONS).parquet(path).select(
        "id", "db_id", F.length("question").cast("bigint").alias("question_chars"), "domain",
        F.col("created_at").isNotNull().alias("stamped"))


@query("k_duplicate_keys", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def k_duplicate_keys(spark, folder):
    return duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey"])


@query("k_key_check", """
    SELECT count(*) AS distinct_keys, count(CASE WHEN n > 1 THEN 1 END) AS duplicate_keys, 0::BIGINT AS null_key_rows
    FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def k_key_check(spark, folder):
    return key_check(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("k_load_checks", f"""
    SELECT 'total_questions' AS check, count(*) AS value, count(*) > 0 AS ok FROM documents
    UNION ALL SELECT 'question_databases', count(DISTINCT source), true FROM documents
    UNION ALL SELECT 'questions_without_sql', count(*) FILTER (coalesce(text, '') = ''),
              count(*) FILTER (coalesce(text, '') = '') = 0 FROM documents
    UNION ALL SELECT 'unique_databases', count(*), true FROM {DB}
    UNION ALL SELECT 'database_records', count(*), true FROM {DB}
    UNION ALL SELECT 'schema_records', cast(sum(11 + 5 * (b % 2 = 0)::INT) AS BIGINT), true FROM {DB}
    UNION ALL SELECT 'foreign_key_relationships', count(*), true FROM {DB}
    UNION ALL SELECT 'tables_with_data', count(*), true FROM {TABLES}
    UNION ALL SELECT 'tables_without_data', 0, true""")
def k_load_checks(spark, folder):
    profile = order_catalog(spark, folder)
    return load_checks(
        questions=document_questions(spark, folder),
        databases=c.database_records(profile.files, profile.tables),
        schemas=c.table_schemas(profile.columns, profile.fks),
        foreign_keys=c.foreign_keys(profile.fks),
        table_info=mark_loaded(c.table_data_info(profile.tables), order_log(spark, folder)))


@query("k_report", f"""
    SELECT domain, count(*) AS count, avg(complexity_score)::DOUBLE AS avg_complexity,
           cast(sum(table_count) AS BIGINT) AS total_tables, cast(sum(total_rows) AS BIGINT) AS total_rows
    FROM {SCORED} GROUP BY domain""")
def k_report(spark, folder):
    path = fresh_path(spark, "report")
    databases, tables = scored_databases(spark, folder), order_catalog(spark, folder).tables
    write_report(databases, tables, path)
    schema = "domain string, count bigint, avg_complexity double, total_tables bigint, total_rows bigint"
    return spark.read.schema(schema).json(f"{path}/domain_summary")


@query("k_report_parts", f"""
    SELECT part, CASE WHEN n = 0 THEN 1 ELSE n END AS n_rows, CASE WHEN part = 'total_databases' THEN total END AS total FROM (
        SELECT unnest(['domain_summary', 'domain_members', 'complexity_analysis', 'total_databases', 'database_list']) AS part,
               unnest([(SELECT count(DISTINCT domain) FROM {SCORED}), (SELECT count(*) FROM {DB}), 0, 0, (SELECT count(*) FROM {DB})]) AS n,
               (SELECT count(*) FROM {DB}) AS total)""")
def k_report_parts(spark, folder):
    """All sections of the report as they were written."""
    path, profile = fresh_path(spark, "report"), order_catalog(spark, folder)
    parts = write_report(scored_databases(spark, folder), profile.tables, path, profile.found)
    return reduce(DataFrame.unionByName, [
        spark.read.schema("total_databases bigint").json(f"{path}/{part}").agg(
            F.count("*").alias("n_rows"), F.max("total_databases").alias("total")).withColumn("part", F.lit(part))
        for part in parts])


@query("k_report_databases", f"""
    SELECT s.db_id, domain, table_count::BIGINT AS table_count, total_rows, tables FROM {SCORED} s JOIN (
        SELECT db_id, string_agg(table_name, ',' ORDER BY table_name) AS tables FROM {TABLES} GROUP BY db_id) t
    ON s.db_id = t.db_id""")
def k_report_databases(spark, folder):
    path = fresh_path(spark, "report")
    databases, tables = scored_databases(spark, folder), order_catalog(spark, folder).tables
    part = report_parts(databases, tables)["database_list"]
    part.write.option("ignoreNullFields", "false").json(path)
    return spark.read.schema(part.schema).json(path).select(
        "db_id", "domain", "table_count", "total_rows", F.array_join("tables", ",").alias("tables"))


# Statements over the driver's tables, each with its success.
STORED = {
    "orders_by_status": ("SELECT o_orderstatus, count(*) AS n FROM lakecat_orders GROUP BY o_orderstatus", True),
    "customers_in_debt": ("SELECT c_name FROM lakecat_customer WHERE c_acctbal < 0 ORDER BY c_acctbal;", True),
    "lines_per_order": ("WITH l AS (SELECT l_orderkey, count(*) AS n FROM lakecat_lineitem GROUP BY l_orderkey)"
                        " SELECT * FROM l WHERE n > 3", True),
    "same_name_twice": ("SELECT a.n_name, b.n_name FROM lakecat_nation a JOIN lakecat_nation b"
                        " ON a.n_regionkey = b.n_regionkey", True),
    "no_such_column": ("SELECT missing FROM lakecat_orders", False),
    "a_command": ("DROP VIEW lakecat_orders", False),
    "two_statements": ("SELECT 1; DROP VIEW lakecat_orders", False),
    "open_brackets": ("SELECT 1) AS a, (SELECT 2", False),
    "with_comments": ("-- regions\nSELECT r_name FROM lakecat_region; -- done", True),
}


def _stored_oracle() -> str:
    rows = []
    for name, (statement, ok) in STORED.items():
        plain = statement.replace("lakecat_", "").removesuffix("; -- done").rstrip(";").replace(", b.n_name", "")
        value = f"(SELECT count(*) FROM ({plain}))" if ok else "NULL::BIGINT"
        rows.append(f"SELECT '{name}' AS question_id, {value} AS result_rows, {str(ok).lower()} AS execution_success")
    return " UNION ALL ".join(rows)


@query("k_stored_queries", _stored_oracle())
def k_stored_queries(spark, folder):
    for name in TABLE_NAMES:
        table(spark, folder, name).createOrReplaceTempView(f"lakecat_{name}")
    records = [{"id": name, "sql_query": statement} for name, (statement, _) in STORED.items()]
    questions = records_frame(spark, records, "id string, sql_query string")
    results = run_stored_queries(questions, fresh_path(spark, "execution_results"))
    return results.select("question_id", "result_rows", "execution_success")
