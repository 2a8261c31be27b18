"""Counts, samples, tops and customer reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakecat.bindings import TABLES, query, table
from lakecat.bindings.views import MONEY, customer_databases, document_questions, order_load_state
from lakecat.functions.text import exact_sum
from lakecat.plans import queries as q


def judged_documents(spark: SparkSession, folder: str) -> DataFrame:
    """documents with their quality label, where there is one, as difficulty."""
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("difficulty"))
    return document_questions(spark, folder).drop("difficulty").join(labels, "id", "left")


@query("q_total", "SELECT count(*) AS total_questions FROM documents")
def q_total(spark, folder):
    return q.total(document_questions(spark, folder), "total_questions")


@query("q_distinct_db", "SELECT count(DISTINCT source) AS unique_databases FROM documents")
def q_distinct_db(spark, folder):
    return q.distinct_total(document_questions(spark, folder), "db_id", "unique_databases")


@query("q_top_domains", """
    SELECT source AS domain, count(*) AS count FROM documents GROUP BY source
    ORDER BY count DESC, domain LIMIT 5""")
def q_top_domains(spark, folder):
    return q.most_frequent(document_questions(spark, folder), "domain", 5)


@query("q_difficulty", """
    SELECT quality AS difficulty, count(*) AS count FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    WHERE quality IS NOT NULL GROUP BY quality""")
def q_difficulty(spark, folder):
    return q.counts_by_difficulty(judged_documents(spark, folder))


@query("q_loaded", "SELECT count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS tables_with_data FROM orders")
def q_loaded(spark, folder):
    return q.total_where(order_load_state(spark, folder), F.col("data_loaded"), "tables_with_data")


@query("m_db_summary", """
    SELECT n_name AS domain, count(*) AS database_count, cast(sum(s_nationkey) AS BIGINT) AS total_tables,
           cast(sum(cast(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(s_acctbal) AS avg_size_mb
    FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name""")
def m_db_summary(spark, folder):
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    databases = table(spark, folder, "supplier").join(nations, "s_nationkey").select(
        F.col("n_name").alias("domain"), F.col("s_nationkey").alias("num_tables"),
        F.col("s_acctbal").cast(MONEY).alias("size_mb"))
    return q.databases_by_domain(databases)


@query("m_tables_by_db", """
    SELECT p_partkey AS db_id, p_size AS num_tables, p_name AS description FROM part
    ORDER BY num_tables DESC, db_id""")
def m_tables_by_db(spark, folder):
    return q.tables_by_database(table(spark, folder, "part").select(
        F.col("p_partkey").alias("db_id"), F.col("p_size").alias("num_tables"), F.col("p_name").alias("description")))


@query("m_questions_by_domain", """
    SELECT source AS domain, count(*) AS question_count, avg(length(text)) AS avg_question_length
    FROM documents GROUP BY source ORDER BY question_count DESC, domain LIMIT 5""")
def m_questions_by_domain(spark, folder):
    return q.questions_by_domain(document_questions(spark, folder))


def customers_and_orders(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    customers = table(spark, folder, "customer").withColumnRenamed("c_custkey", "customer_id")
    orders = table(spark, folder, "orders").withColumnRenamed("o_custkey", "customer_id")
    return customers, orders


@query("m_top_balances", """
    SELECT c_name, o_totalprice, o_orderstatus, o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 5""")
def m_top_balances(spark, folder):
    return q.joined_top(
        *customers_and_orders(spark, folder), "customer_id", [F.desc("o_totalprice"), F.col("o_orderkey")], 5,
        ["c_name", "o_totalprice", "o_orderstatus", "o_orderkey"])


@query("m_latest_orders", """
    SELECT c_name, o_orderdate, o_totalprice, o_orderstatus, o_orderkey
    FROM customer JOIN orders ON c_custkey = o_custkey ORDER BY o_orderdate DESC, o_orderkey LIMIT 5""")
def m_latest_orders(spark, folder):
    return q.joined_top(
        *customers_and_orders(spark, folder), "customer_id", [F.desc("o_orderdate"), F.col("o_orderkey")], 5,
        ["c_name", "o_orderdate", "o_totalprice", "o_orderstatus", "o_orderkey"])


def label_counts(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    return q.left_counts(documents, table(spark, folder, "labels"), "doc_id", "quality", "label_count")


@query("m_left_count", """
    SELECT d.doc_id, d.lang, d.source, d.n_chars, count(l.quality) AS label_count
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    GROUP BY d.doc_id, d.lang, d.source, d.n_chars ORDER BY d.n_chars DESC, d.doc_id LIMIT 5""")
def m_left_count(spark, folder):
    return label_counts(spark, folder).orderBy(F.desc("n_chars"), "doc_id").limit(5)


@query("m_left_count_all", """
    SELECT d.doc_id, d.lang, d.source, d.n_chars, count(l.quality) AS label_count
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.doc_id, d.lang, d.source, d.n_chars""")
def m_left_count_all(spark, folder):
    return label_counts(spark, folder)


@query("t_preview", """
    SELECT doc_id AS id, source AS db_id, left(text, 100) AS question_preview FROM documents ORDER BY doc_id LIMIT 3""")
def t_preview(spark, folder):
    return q.preview(document_questions(spark, folder))


@query("t_top_db", """
    SELECT source AS db_id, count(*) AS count FROM documents GROUP BY source ORDER BY count DESC, db_id LIMIT 3""")
def t_top_db(spark, folder):
    return q.most_frequent(document_questions(spark, folder), "db_id", 3)


@query("t_summary", """
    SELECT domain, question_count, avg_question_length FROM (
        SELECT source AS domain, count(*) AS question_count, avg(length(text)) AS avg_question_length
        FROM documents WHERE source IS NOT NULL GROUP BY source ORDER BY source LIMIT 5)""")
def t_summary(spark, folder):
    from lakecat.plans.views import test_summary

    return test_summary(document_questions(spark, folder))


@query("t_sql_complexity", """
    SELECT lang AS difficulty, count(*) AS count, avg(length(text)) AS avg_sql_length
    FROM documents WHERE lang IS NOT NULL GROUP BY lang""")
def t_sql_complexity(spark, folder):
    return q.sql_length_by_difficulty(document_questions(spark, folder))


@query("d_row_counts", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in TABLES))
def d_row_counts(spark, folder):
    return q.row_counts({name: table(spark, folder, name) for name in TABLES})


@query("d_samples", """
    SELECT * FROM orders ORDER BY o_orderkey LIMIT 3""")
def d_samples(spark, folder):
    return q.sample(table(spark, folder, "orders"), "o_orderkey")


@query("d_projection", "SELECT c_name, c_mktsegment, c_nationkey FROM customer ORDER BY c_custkey LIMIT 5")
def d_projection(spark, folder):
    return q.sample(table(spark, folder, "customer"), "c_custkey", 5, ["c_name", "c_mktsegment", "c_nationkey"])


@query("d_balance_by_type", """
    SELECT c_mktsegment AS account_type, cast(sum(cast(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS total_balance
    FROM customer GROUP BY c_mktsegment""")
def d_balance_by_type(spark, folder):
    accounts = table(spark, folder, "customer").withColumnRenamed("c_mktsegment", "account_type")
    return q.sum_by(accounts, "account_type", F.col("c_acctbal").cast(MONEY), "total_balance")


def chain(spark: SparkSession, folder: str, lines: DataFrame) -> DataFrame:
    customers, orders = customers_and_orders(spark, folder)
    return q.chain_summary(
        customers, orders.withColumnRenamed("o_orderkey", "account_id"),
        lines.withColumnRenamed("l_orderkey", "account_id"), ["c_name"], F.col("l_extendedprice").cast(MONEY))


@query("d_customer_summary", """
    SELECT c_custkey AS customer_id, c_name, count(l_linenumber) AS transaction_count,
           cast(sum(cast(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
           cast(sum(cast(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(l_extendedprice) AS avg_amount
    FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey
    GROUP BY c_custkey, c_name""")
def d_customer_summary(spark, folder):
    return chain(spark, folder, table(spark, folder, "lineitem"))


@query("g_avg_since", """
    SELECT c_custkey AS customer_id, c_name,
           cast(sum(cast(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(l_extendedprice) AS avg_amount
    FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey
    WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00' GROUP BY c_custkey, c_name""")
def g_avg_since(spark, folder):
    lines = table(spark, folder, "lineitem")
    since = F.lit("1998-01-01").cast(lines.schema["l_shipdate"].dataType)
    return chain(spark, folder, lines.filter(F.col("l_shipdate") >= since)).select(
        "customer_id", "c_name", "avg_amount")


@query("g_sum_filter", """
    SELECT cast(sum(cast(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_balance
    FROM orders WHERE o_orderstatus = 'F'""")
def g_sum_filter(spark, folder):
    return q.sum_where(
        table(spark, folder, "orders"), F.col("o_orderstatus") == "F", F.col("o_totalprice").cast(MONEY),
        "total_balance")


@query("g_has_both", """
    SELECT DISTINCT c_custkey AS customer_id, c_name FROM customer
    JOIN orders a ON c_custkey = a.o_custkey AND a.o_orderpriority = '1-URGENT'
    JOIN orders b ON c_custkey = b.o_custkey AND b.o_orderpriority = '5-LOW'""")
def g_has_both(spark, folder):
    customers, orders = customers_and_orders(spark, folder)
    return q.having_both(customers, orders, "o_orderpriority", "1-URGENT", "5-LOW", ["c_name"])


@query("r_filter_limit", """
    SELECT db_id, question, sql_query FROM (
        SELECT source AS db_id, text AS question, text AS sql_query, doc_id FROM documents
        WHERE source = 'src0' ORDER BY doc_id LIMIT 5)""")
def r_filter_limit(spark, folder):
    return q.where_limited(
        document_questions(spark, folder), F.col("db_id") == "src0", "id", 5, ["db_id", "question", "sql_query"])


@query("r_availability", """
    SELECT o_custkey AS db_id, count(*) AS table_count,
           cast(sum(cast(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_rows
    FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey""")
def r_availability(spark, folder):
    out = q.loaded_rows_by_database(order_load_state(spark, folder))
    return out.withColumn("total_rows", F.col("total_rows").cast("double"))


@query("r_in_top1", """
    SELECT p_partkey, p_name FROM part WHERE p_type IN ('PROMO', 'SMALL')
    ORDER BY p_retailprice DESC, p_partkey LIMIT 1""")
def r_in_top1(spark, folder):
    return q.best_of(
        table(spark, folder, "part"), "p_type", ["PROMO", "SMALL"], [F.desc("p_retailprice"), F.col("p_partkey")],
        ["p_partkey", "p_name"])


@query("j_inner", """
    SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey""")
def j_inner(spark, folder):
    customers, orders = customers_and_orders(spark, folder)
    return orders.join(customers, "customer_id").select("o_orderkey", "c_name", "o_totalprice")


@query("a_extremes", """
    SELECT o_orderpriority, min(o_totalprice) AS low, max(o_totalprice) AS high,
           min(CASE WHEN o_totalprice = bottom THEN o_orderkey END) AS cheapest,
           max(CASE WHEN o_totalprice = top THEN o_orderkey END) AS dearest
    FROM (SELECT *, max(o_totalprice) OVER (PARTITION BY o_orderpriority) AS top,
          min(o_totalprice) OVER (PARTITION BY o_orderpriority) AS bottom FROM orders)
    GROUP BY o_orderpriority""")
def a_extremes(spark, folder):
    placed = F.when(F.col("o_totalprice").isNotNull(), F.struct("o_totalprice", "o_orderkey"))
    return table(spark, folder, "orders").groupBy("o_orderpriority").agg(
        F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"),
        F.min_by("o_orderkey", placed).alias("cheapest"), F.max_by("o_orderkey", placed).alias("dearest"))


@query("w_predicates", """
    SELECT source, count(CASE WHEN lang = 'en' THEN 1 END) AS equal,
           count(CASE WHEN lang IN ('de', 'fr') THEN 1 END) AS listed,
           count(CASE WHEN lang IN ('de', 'fr') OR length(text) > 200 THEN 1 END) AS either,
           count(CASE WHEN text LIKE '%the%' THEN 1 END) AS liked,
           count(CASE WHEN quality IS NOT NULL THEN 1 END) AS judged
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY source""")
def w_predicates(spark, folder):
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    # Text becomes three flags before the join, so that the shuffle carries no text.
    flags = table(spark, folder, "documents").select(
        "doc_id", "source", "lang", (F.length("text") > 200).alias("is_long"),
        F.col("text").like("%the%").alias("liked"))
    listed = F.col("lang").isin("de", "fr")
    return flags.join(labels, "doc_id", "left").groupBy("source").agg(
        F.count_if(F.col("lang") == "en").alias("equal"), F.count_if(listed).alias("listed"),
        F.count_if(listed | F.col("is_long")).alias("either"), F.count_if("liked").alias("liked"),
        F.count_if(F.col("quality").isNotNull()).alias("judged"))


@query("w_since", """
    SELECT l_returnflag, count(*) AS n, cast(sum(cast(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
    FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00' GROUP BY l_returnflag""")
def w_since(spark, folder):
    lines = table(spark, folder, "lineitem")
    since = F.lit("1998-01-01").cast(lines.schema["l_shipdate"].dataType)
    return lines.filter(F.col("l_shipdate") >= since).groupBy("l_returnflag").agg(
        F.count("*").alias("n"), exact_sum(F.col("l_extendedprice")).alias("amount"))


@query("m_databases_of_customers", """
    SELECT c_mktsegment AS domain, count(*) AS database_count, cast(sum(c_nationkey) AS BIGINT) AS total_tables,
           cast(sum(cast(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(c_acctbal) AS avg_size_mb
    FROM customer GROUP BY c_mktsegment""")
def m_databases_of_customers(spark, folder):
    return q.databases_by_domain(customer_databases(spark, folder))
