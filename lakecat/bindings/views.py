"""Analysis views over documents (as questions) and the order tables (as catalog facts)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakecat.bindings import query, table
from lakecat.plans import views

MONEY = "decimal(18,2)"


def document_questions(spark: SparkSession, folder: str, domain: str = "source") -> DataFrame:
    """documents in the role of the questions table."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.col("source").alias("db_id"), F.col("text").alias("question"),
        F.col("text").alias("sql_query"), F.col("lang").alias("difficulty"), F.col(domain).alias("domain"))


def customer_databases(spark: SparkSession, folder: str) -> DataFrame:
    """customer in the role of the databases table."""
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("db_id"), F.col("c_mktsegment").alias("domain"),
        F.col("c_nationkey").alias("num_tables"), F.col("c_acctbal").cast(MONEY).alias("size_mb"))


def order_databases(spark: SparkSession, folder: str) -> DataFrame:
    """orders in the role of the databases table."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("db_id"), F.col("o_orderpriority").alias("domain"))


def order_load_state(spark: SparkSession, folder: str) -> DataFrame:
    """orders in the role of the load state: one table each, loaded when finished."""
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("db_id"), (F.col("o_orderstatus") == "F").alias("data_loaded"),
        F.col("o_totalprice").cast(MONEY).alias("row_count"))


@query("v_summary", """
    SELECT lang AS domain, count(*) AS question_count, count(DISTINCT source) AS database_count,
           avg(length(text)) AS avg_question_length, avg(length(text)) AS avg_sql_length
    FROM documents GROUP BY lang""")
def v_summary(spark, folder):
    return views.summary(document_questions(spark, folder, "lang"))


V_COMPLEX = """
    SELECT doc_id AS id, source AS db_id, text AS question, lang AS difficulty, length(text) AS sql_length,
           (length(text) - length(replace(text, 'the', ''))) / 3 AS join_count
    FROM documents WHERE lang IN ('de', 'fr') OR length(text) > 5000"""


def complex_documents(spark, folder):
    return views.complex_questions(document_questions(spark, folder), ["de", "fr"], 5000, "the")


@query("v_complex", V_COMPLEX)
def v_complex(spark, folder):
    return complex_documents(spark, folder)


V_DOMAIN_COMPLEXITY = """
    SELECT source AS domain, avg(length(text)) AS avg_sql_complexity,
           count(CASE WHEN text LIKE '%the%' THEN 1 END) AS join_questions,
           count(CASE WHEN text LIKE '%ing%' OR text LIKE '%(%' THEN 1 END) AS subquery_questions,
           count(*) AS total_questions
    FROM documents GROUP BY source"""


def document_complexity(spark, folder):
    return views.domain_complexity(document_questions(spark, folder), ("the",), ("ing", "("))


@query("v_domain_complexity", V_DOMAIN_COMPLEXITY)
def v_domain_complexity(spark, folder):
    return document_complexity(spark, folder)


@query("v_comprehensive", """
    SELECT c_mktsegment AS domain, count(DISTINCT o_custkey) AS database_count,
           count(o_orderkey) AS question_count, avg(length(o_orderpriority)) AS avg_question_length,
           avg(length(o_orderstatus)) AS avg_sql_length, cast(sum(c_nationkey) AS BIGINT) AS total_tables,
           cast(sum(cast(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(c_acctbal) AS avg_db_size_mb
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""")
def v_comprehensive(spark, folder):
    questions = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("db_id"),
        F.col("o_orderpriority").alias("question"), F.col("o_orderstatus").alias("sql_query"))
    return views.comprehensive_summary(questions, customer_databases(spark, folder))


@query("v_schema_overview", """
    SELECT l_orderkey AS db_id, o_orderpriority AS domain, count(DISTINCT l_partkey) AS table_count,
           count(l_linenumber) AS total_columns,
           count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS primary_key_columns,
           count(CASE WHEN l_linestatus = 'O' THEN 1 END) AS foreign_key_columns
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey, o_orderpriority""")
def v_schema_overview(spark, folder):
    schemas = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("db_id"), F.col("l_partkey").alias("table_name"),
        F.col("l_linenumber").alias("column_name"), (F.col("l_returnflag") == "R").alias("is_primary_key"),
        (F.col("l_linestatus") == "O").alias("is_foreign_key"))
    return views.schema_overview(schemas, order_databases(spark, folder))


@query("v_availability", """
    SELECT o_custkey AS db_id, c_mktsegment AS domain, count(*) AS total_tables,
           count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS tables_loaded,
           cast(sum(cast(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_rows,
           cast(sum(cast(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS avg_rows_per_table
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_custkey, c_mktsegment""")
def v_availability(spark, folder):
    out = views.data_availability(order_load_state(spark, folder), customer_databases(spark, folder))
    return out.withColumn("total_rows", F.col("total_rows").cast("double"))


@query("v_relationships", """
    SELECT l_orderkey AS db_id, o_orderpriority AS domain, count(*) AS foreign_key_count,
           count(DISTINCT l_suppkey) AS tables_with_fks, count(DISTINCT l_partkey) AS referenced_tables
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey, o_orderpriority""")
def v_relationships(spark, folder):
    fks = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("db_id"), F.col("l_suppkey").alias("source_table"),
        F.col("l_partkey").alias("target_table"))
    return views.relationship_complexity(fks, order_databases(spark, folder))


@query("r_join_pct", f"""
    SELECT domain, join_questions, total_questions,
           (join_questions::DOUBLE / total_questions) * 100 AS join_percentage
    FROM ({V_DOMAIN_COMPLEXITY})""")
def r_join_pct(spark, folder):
    return views.join_percentage(document_complexity(spark, folder))


@query("r_view_summary", """
    SELECT source AS domain, count(*) AS question_count, count(DISTINCT source) AS database_count,
           avg(length(text)) AS avg_question_length, avg(length(text)) AS avg_sql_length
    FROM documents GROUP BY source""")
def r_view_summary(spark, folder):
    views.publish({"lakecat_summary": views.summary(document_questions(spark, folder))})
    return views.read_view(spark, "lakecat_summary", [F.desc("question_count"), F.col("domain")])


@query("r_view_complex", f"""
    SELECT id, question, difficulty, sql_length FROM ({V_COMPLEX}) ORDER BY sql_length DESC, id LIMIT 10""")
def r_view_complex(spark, folder):
    views.publish({"lakecat_complex_questions": complex_documents(spark, folder)})
    first = views.read_view(spark, "lakecat_complex_questions", [F.desc("sql_length"), F.col("id")], 10)
    return first.select("id", "question", "difficulty", "sql_length")
