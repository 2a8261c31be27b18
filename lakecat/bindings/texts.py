"""Names, ids, declared types and text measures over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakecat.bindings import query, table
from lakecat.functions import naming, text, typemap
from lakecat.operators.sequence import with_sequence

DECLARED = [
    "INTEGER", "integer", "INT", "BIGINT", "VARCHAR(50)", "NVARCHAR(20)", "varchar", "TINYTEXT", "DECIMAL(5,4)",
    "DECIMAL", "NUMERIC", "REAL", "FLOAT", "DOUBLE", "BOOLEAN", "", "DATE", "DATETIME", "TIMESTAMP", "BLOB", "text",
]


@query("f_ids", """
    SELECT doc_id, printf('lake_%06d', n) AS id, 'q_' || n AS question_id_original
    FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS n FROM documents)""")
def f_ids(spark, folder):
    numbered = with_sequence(table(spark, folder, "documents").select("doc_id"), "doc_id")
    return numbered.select(
        "doc_id", naming.padded_id(F.col("pos"), "lake", 6).alias("id"),
        naming.original_id(F.col("pos")).alias("question_id_original"))


@query("f_record_ids", """
    SELECT l_orderkey, l_linenumber, l_orderkey || '_' || l_linenumber || '_' || l_partkey AS id FROM lineitem""")
def f_record_ids(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber",
        naming.record_id(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")).alias("id"))


@query("f_target_names", """
    SELECT p_partkey, upper('LAKE_' || p_brand || '_' || p_name) AS target_table_name FROM part""")
def f_target_names(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", naming.target_table_name(F.col("p_brand"), F.col("p_name")).alias("target_table_name"))


@query("f_clean_ids", r"""
    SELECT page_id, regexp_replace(url, '[^\p{L}\p{N}_-]', '', 'g') AS file_id FROM pages""")
def f_clean_ids(spark, folder):
    return table(spark, folder, "pages").select("page_id", naming.clean_file_id(F.col("url")).alias("file_id"))


@query("f_clean_collisions", r"""
    SELECT file_id, count(*) AS n_ids, min(id) AS first_id, max(id) AS last_id FROM (
        SELECT DISTINCT regexp_replace(url, '[^\p{L}\p{N}_-]', '', 'g') AS file_id, url AS id FROM pages)
    GROUP BY file_id HAVING count(*) > 1""")
def f_clean_collisions(spark, folder):
    return naming.colliding_ids(table(spark, folder, "pages"), "url")


@query("f_column_names", """
    SELECT p_partkey AS PART_KEY, p_name AS PART_NAME, p_size AS PART_SIZE FROM part""")
def f_column_names(spark, folder):
    part = table(spark, folder, "part").selectExpr(
        "p_partkey AS `part key`", "p_name AS `part-name`", "p_size AS part_size")
    return naming.normalise_columns(part)


@query("f_upper_columns", "SELECT n_nationkey AS N_NATIONKEY, s_suppkey AS S_SUPPKEY, s_name AS S_NAME"
                          " FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def f_upper_columns(spark, folder):
    nations = table(spark, folder, "nation").select("n_nationkey")
    suppliers = table(spark, folder, "supplier")
    joined = suppliers.join(nations, suppliers.s_nationkey == nations.n_nationkey)
    return naming.upper_columns(joined.select("n_nationkey", "s_suppkey", "s_name"))


def _declared_sql() -> str:
    listed = ", ".join(f"'{declared}'" for declared in DECLARED)
    return f"(SELECT p_partkey, ([{listed}])[p_partkey % {len(DECLARED)} + 1] AS declared FROM part)"


def _map_sql(mapping: dict[str, str], passing: list[str] = ()) -> str:
    cases = [f"WHEN contains(upper(declared), '{part}') THEN declared" for part in passing]
    cases += [f"WHEN contains(upper(declared), '{key}') THEN '{value}'" for key, value in mapping.items()]
    return f"CASE {' '.join(cases)} ELSE '{typemap.TEXT_TYPE}' END"


@query("f_type_maps", f"""
    SELECT p_partkey, declared, {_map_sql(typemap.PLAIN_MAP)} AS plain_type,
           {_map_sql(typemap.SIZED_MAP, typemap.SIZED_PASS_THROUGH)} AS sized_type FROM {_declared_sql()}""")
def f_type_maps(spark, folder):
    listed = F.array(*map(F.lit, DECLARED))
    declared = F.element_at(listed, (F.col("p_partkey") % len(DECLARED)).cast("int") + 1)
    part = table(spark, folder, "part").select("p_partkey", declared.alias("declared"))
    return part.select(
        "p_partkey", "declared", typemap.plain_type(F.col("declared")).alias("plain_type"),
        typemap.sized_type(F.col("declared")).alias("sized_type"))


@query("f_text_measures", """
    SELECT doc_id, length(text) AS chars, left(text, 100) AS preview, substring(text, 1, 1000) AS cut,
           (length(text) - length(replace(text, 'the', ''))) / 3 AS the_count FROM documents""")
def f_text_measures(spark, folder):
    value = F.col("text")
    return table(spark, folder, "documents").select(
        "doc_id", F.length(value).cast("bigint").alias("chars"), text.truncated(value, 100).alias("preview"),
        text.truncated(value, 1000).alias("cut"), text.token_count(value, "the").alias("the_count"))


@query("f_conditional_rates", """
    SELECT o_orderpriority, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS done, count(*) AS total,
           (count(CASE WHEN o_orderstatus = 'F' THEN 1 END)::DOUBLE / count(*)) * 100 AS done_percentage
    FROM orders GROUP BY o_orderpriority""")
def f_conditional_rates(spark, folder):
    counted = table(spark, folder, "orders").groupBy("o_orderpriority").agg(
        text.count_where(F.col("o_orderstatus") == "F").alias("done"), F.count("*").alias("total"))
    return counted.withColumn("done_percentage", text.percentage(F.col("done"), F.col("total")))


@query("f_keyword_in_name", """
    SELECT p_partkey, upper(p_name) AS upper_name, lower(p_brand) AS lower_brand,
           contains(lower(p_name), 'widget') OR contains(lower(p_name), 'real_estate') AS has_keyword FROM part""")
def f_keyword_in_name(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", F.upper("p_name").alias("upper_name"), F.lower("p_brand").alias("lower_brand"),
        text.has_any(F.lower("p_name"), "widget", "real_estate").alias("has_keyword"))
