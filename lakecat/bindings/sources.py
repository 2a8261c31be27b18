"""Splits, slices, discovery and payloads over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakecat.bindings import TABLES, query, table
from lakecat.functions.naming import record_id
from lakecat.operators.questions import databases_of, normalise_questions, positional_slice, questions_from
from lakecat.sources import files, payloads, splits


def document_records(spark: SparkSession, folder: str) -> DataFrame:
    """documents read as a split: records with their position in the files."""
    return splits.read_split(spark, f"{folder}/documents.parquet")


def dev_records(spark: SparkSession, folder: str) -> DataFrame:
    return as_dev(document_records(spark, folder))


def as_dev(records: DataFrame) -> DataFrame:
    return records.select(
        "pos", record_id(F.col("source"), F.col("lang"), F.lit("shop")).alias("db_id"),
        F.col("text").alias("question"), F.lit(None).cast("string").alias("evidence"), F.col("text").alias("SQL"),
        F.col("doc_id").alias("question_id"))


def flash_records(spark: SparkSession, folder: str) -> DataFrame:
    return document_records(spark, folder).select(
        "pos", F.col("source").alias("db_id"), F.col("text").alias("query"),
        F.when(F.col("lang") != "fr", F.col("text")).alias("clean_up_sql"), F.col("text").alias("preprocess_sql"),
        F.col("lang").alias("difficulty_tier"))


NUMBERED = "(SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents)"

DEV_SQL = f"""
    SELECT printf('lake_%06d', pos) AS id, source || '_' || lang || '_shop' AS db_id, text AS question,
           CAST(NULL AS VARCHAR) AS evidence, text AS sql_query, 'unknown' AS difficulty,
           CASE WHEN source IS NULL OR lang IS NULL THEN 'general' ELSE 'retail' END AS domain,
           cast(doc_id AS VARCHAR) AS question_id_original FROM {NUMBERED}"""


@query("s_read_split", f"SELECT pos, doc_id, lang FROM {NUMBERED}")
def s_read_split(spark, folder):
    return document_records(spark, folder).select("pos", "doc_id", "lang")


@query("k_questions_dev", DEV_SQL)
def k_questions_dev(spark, folder):
    return normalise_questions(dev_records(spark, folder))


@query("k_questions_flash", f"""
    SELECT printf('lake_%06d', pos) AS id, source AS db_id, text AS question, '' AS evidence,
           CASE WHEN lang <> 'fr' THEN text END AS sql_query, lang AS difficulty, 'general' AS domain,
           'q_' || pos AS question_id_original FROM {NUMBERED}""")
def k_questions_flash(spark, folder):
    return questions_from({"flash": flash_records(spark, folder)})


@query("s_source_choice", f"SELECT domain, count(*) AS n, min(id) AS first_id FROM ({DEV_SQL}) GROUP BY domain")
def s_source_choice(spark, folder):
    chosen = questions_from({
        "flash": flash_records(spark, folder), "mini_dev_sqlite": dev_records(spark, folder)})
    return chosen.groupBy("domain").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))


@query("s_slice", f"""
    SELECT printf('test_%03d', pos) AS id, source || '_' || lang || '_shop' AS db_id, left(text, 1000) AS question,
           left(text, 2000) AS sql_query, 'unknown' AS difficulty FROM {NUMBERED} WHERE pos < 50""")
def s_slice(spark, folder):
    first = splits.first_records(spark, f"{folder}/documents.parquet", min(100, 50), ["doc_id", "text", "source", "lang"])
    smoke = normalise_questions(as_dev(first), id_prefix="test", id_width=3, question_chars=1000, sql_chars=2000)
    return smoke.select("id", "db_id", "question", "sql_query", "difficulty")


@query("s_sorted_slice", f"SELECT pos, doc_id FROM {NUMBERED} WHERE pos < 70")
def s_sorted_slice(spark, folder):
    """The first records of numbered ones that lie in no file any more."""
    return positional_slice(document_records(spark, folder).select("pos", "doc_id"), 70, limit=90)


@query("p_first_seen", f"""
    SELECT source AS db_id, source AS db_name, 'general' AS domain, 0::BIGINT AS num_tables,
           'Benchmark database: ' || source AS description, 0.0::DOUBLE AS size_mb, min(pos) AS first_pos
    FROM {NUMBERED} WHERE source <> '' GROUP BY source""")
def p_first_seen(spark, folder):
    return databases_of(flash_records(spark, folder))


# --- discovery over a listing that the pages imply ---

LISTED = """
    (SELECT page_id, '/lake/' || ['raw', 'database_a', 'x_databases/inner', 'databases/database_b'][page_id % 4 + 1]
            || '/' || 'f' || page_id || ['.sqlite', '.db', '.SQLite3', '.txt', ''][page_id % 5 + 1] AS path,
            length(html) AS length FROM pages)"""


def listed_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of one made-up file per page."""
    folders = F.array(*map(F.lit, ["raw", "database_a", "x_databases/inner", "databases/database_b"]))
    suffixes = F.array(*map(F.lit, [".sqlite", ".db", ".SQLite3", ".txt", ""]))
    number = F.col("page_id").cast("int")
    return table(spark, folder, "pages").select(
        F.concat(
            F.lit("/lake/"), F.element_at(folders, number % 4 + 1), F.lit("/f"), F.col("page_id"),
            F.element_at(suffixes, number % 5 + 1)).alias("path"),
        F.length("html").cast("bigint").alias("length"))


@query("s_suffixed_files", f"""
    SELECT 'f' || page_id AS db_id, path, length FROM {LISTED} WHERE page_id % 5 IN (0, 1, 2)""")
def s_suffixed_files(spark, folder):
    return files.suffixed(listed_files(spark, folder)).select("db_id", "path", "length")


@query("s_header_candidates", f"""
    SELECT 'f' || page_id AS db_id, path, length FROM {LISTED} WHERE page_id % 5 = 4 AND length > 1024""")
def s_header_candidates(spark, folder):
    return files.header_candidates(listed_files(spark, folder)).select("db_id", "path", "length")


@query("s_database_directories", f"""
    SELECT dir || '_f' || page_id AS db_id, path FROM (
        SELECT page_id, path, unnest(string_split(path, '/')[3:-2]) AS dir FROM {LISTED} WHERE page_id % 5 = 0)
    WHERE contains(dir, 'database')""")
def s_database_directories(spark, folder):
    return files.in_database_directories(listed_files(spark, folder), "/lake").select("db_id", "path")


@query("s_merged_listings", f"""
    SELECT 'k' || (page_id // 3) AS db_id, arg_max(path, (page_id % 2, path)) AS path FROM {LISTED}
    GROUP BY page_id // 3""")
def s_merged_listings(spark, folder):
    listed = listed_files(spark, folder)
    number = F.regexp_extract(files.file_name(F.col("path")), r"^f(\d+)", 1).cast("bigint")
    named = listed.withColumn("number", number).withColumn(
        "db_id", F.concat(F.lit("k"), F.floor(F.col("number") / 3).cast("string")))
    return files.merged(named.filter("number % 2 = 0"), named.filter("number % 2 = 1")).select("db_id", "path")


# --- embedded payloads ---

@query("s_payloads", """
    SELECT kind, count(*) AS n, cast(sum(bytes) AS BIGINT) AS bytes FROM (
        SELECT ['base64', 'url', 'unknown'][doc_id % 3 + 1] AS kind,
               CASE doc_id % 3 WHEN 0 THEN octet_length(encode(text))
                    WHEN 1 THEN length('http://lake/' || doc_id) END AS bytes FROM documents
        WHERE doc_id % 3 <> 0 OR text <> '')
    GROUP BY kind""")
def s_payloads(spark, folder):
    number = F.col("doc_id") % 3
    records = table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("db_id"),
        F.when(number == 0, F.base64(F.encode("text", "utf-8")))
        .when(number == 1, F.concat(F.lit("http://lake/"), F.col("doc_id")))
        .otherwise(F.lit("not a payload!")).alias("db_file"))
    decoded = payloads.decode_payloads(records)
    return decoded.groupBy("kind").agg(F.count("*").alias("n"), F.sum(F.length("payload")).alias("bytes"))


@query("s_live_payloads", """
    SELECT 'livesql_' || doc_id AS db_id, octet_length(encode(text)) AS length FROM documents WHERE text <> ''""")
def s_live_payloads(spark, folder):
    records = table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("db_id"), F.encode("text", "utf-8").alias("database"))
    return payloads.live_payloads({"base_SQLite": records, "other": records}).select(
        "db_id", F.length("payload").cast("bigint").alias("length"))



# Fields of the test tables, by type.
FIELDS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz,"
              " o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
                " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
                " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def _inspect_sql() -> str:
    parts = []
    for source, fields in FIELDS.items():
        for name, kind in (field.split() for field in fields.split(", ")):
            listed = kind.startswith("array")
            length = f"len({name})" if listed else f"length({name}::VARCHAR)"
            sample = f"'<list, length ' || len({name}) || '>'" if listed else f"substring({name}::VARCHAR, 1, 100)"
            parts.append(f"""
                SELECT '{source}' AS source, (SELECT count(*) FROM {source}) AS n_rows, '{name}' AS field, '{kind}' AS type,
                       {str('db' in name).lower()} AS flagged, {length}::BIGINT AS length, {sample} AS sample
                FROM (SELECT * FROM {source} LIMIT 1)""")
    return " UNION ALL ".join(parts)


@query("s_inspect", _inspect_sql())
def s_inspect(spark, folder):
    return splits.inspect_sources({name: table(spark, folder, name) for name in TABLES})
