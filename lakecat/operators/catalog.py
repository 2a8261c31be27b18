"""Catalog tables and reports over profiled databases.

Inputs are flat DataFrames:
  files    (db_id, path, length)
  tables   (db_id, table_name, row_count)
  columns  (db_id, table_name, column_name, column_type, is_primary_key, column_position)
  fks      (db_id, source_table, source_column, target_table, target_column, seq)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakecat.functions.domains import first_match
from lakecat.functions.naming import record_id, target_table_name
from lakecat.functions.rules import DOMAIN_DESCRIPTIONS, FULL_RULES, Rules

MEGABYTE = 1048576.0


def database_records(files: DataFrame, tables: DataFrame, rules: Rules = FULL_RULES,
                     description: str = "Benchmark database: ") -> DataFrame:
    counted = tables.groupBy("db_id").agg(F.countDistinct("table_name").alias("num_tables"))
    return files.join(counted, "db_id").select(
        "db_id",
        F.col("db_id").alias("db_name"),
        first_match(F.col("db_id"), rules).alias("domain"),
        "num_tables",
        F.concat(F.lit(description), F.col("db_id")).alias("description"),
        (F.col("length") / F.lit(MEGABYTE)).alias("size_mb"),
        F.col("path").alias("sqlite_path"),
    )


def table_schemas(columns: DataFrame, fks: DataFrame) -> DataFrame:
    """Column records, marked with the foreign key declared last on the column."""
    last_fk = fks.groupBy("db_id", "source_table", "source_column").agg(
        F.max_by(F.struct("target_table", "target_column"), "seq").alias("fk")
    ).select("db_id", F.col("source_table").alias("table_name"), F.col("source_column").alias("column_name"), "fk")
    return columns.join(last_fk, ["db_id", "table_name", "column_name"], "left").select(
        record_id(F.col("db_id"), F.col("table_name"), F.col("column_name")).alias("id"),
        "db_id", "table_name", "column_name", "column_type", "is_primary_key",
        F.col("fk").isNotNull().alias("is_foreign_key"),
        F.col("fk.target_table").alias("foreign_table"),
        F.col("fk.target_column").alias("foreign_column"),
        "column_position",
    )


def foreign_keys(fks: DataFrame) -> DataFrame:
    return fks.select(
        record_id(F.col("db_id"), F.col("source_table"), F.col("source_column")).alias("id"),
        "db_id", "source_table", "source_column", "target_table", "target_column",
    )


def table_data_info(tables: DataFrame, prefix: str = "LAKE") -> DataFrame:
    return tables.select(
        "db_id", "table_name", "row_count",
        F.lit(False).alias("data_loaded"),
        target_table_name(F.col("db_id"), F.col("table_name"), prefix).alias("target_table_name"),
        F.lit(None).cast("timestamp").alias("load_timestamp"),
    )


def table_records(columns: DataFrame, fks: DataFrame) -> DataFrame:
    """One row per table with its columns as arrays in position order.

    The arrays are as long as one table is wide, which its own database file bounds.
    """
    by_table = columns.groupBy("db_id", "table_name").agg(
        F.array_sort(F.collect_list(
            F.struct("column_position", "column_name", "column_type", "is_primary_key"))).alias("c"))
    fk_lists = fks.groupBy("db_id", F.col("source_table").alias("table_name")).agg(
        F.array_sort(F.collect_list(
            F.struct("seq", "source_column", "target_table", "target_column"))).alias("f"))
    names = F.transform("c", lambda x: x.column_name)
    return by_table.join(fk_lists, ["db_id", "table_name"], "left").select(
        record_id(F.col("db_id"), F.col("table_name")).alias("id"),
        "db_id", "table_name",
        names.alias("column_names"),
        F.transform("c", lambda x: x.column_type).alias("column_types"),
        F.transform(F.filter("c", lambda x: x.is_primary_key), lambda x: x.column_name).alias("primary_keys"),
        F.transform(
            F.coalesce("f", F.array()),
            lambda x: F.struct(x.source_column, x.target_table, x.target_column),
        ).alias("foreign_keys"),
    )


def file_listing(files: DataFrame, tables: DataFrame) -> DataFrame:
    """(db_id, file_path, size_mb, table_count, total_rows); unreadable files count zero."""
    counted = tables.groupBy("db_id").agg(
        F.countDistinct("table_name").alias("t"), F.sum(F.coalesce("row_count", F.lit(0))).alias("r"))
    return files.join(counted, "db_id", "left").select(
        "db_id",
        F.col("path").alias("file_path"),
        F.round(F.col("length") / F.lit(MEGABYTE), 2).alias("size_mb"),
        F.coalesce("t", F.lit(0)).alias("table_count"),
        F.coalesce("r", F.lit(0)).alias("total_rows"),
    )


def listing_totals(listing: DataFrame) -> DataFrame:
    return listing.agg(
        F.count("*").alias("databases"),
        F.coalesce(F.sum("size_mb"), F.lit(0.0)).alias("total_size_mb"),
        F.coalesce(F.sum("table_count"), F.lit(0)).alias("total_tables"),
        F.coalesce(F.sum("total_rows"), F.lit(0)).alias("total_rows"),
    )


def database_totals(tables: DataFrame, columns: DataFrame, fks: DataFrame) -> DataFrame:
    """Counts per database, each side folded on its own before the joins."""
    per_table = tables.groupBy("db_id").agg(
        F.countDistinct("table_name").alias("table_count"), F.sum("row_count").alias("total_rows"))
    per_column = columns.groupBy("db_id").agg(F.count("*").alias("total_columns"))
    per_fk = fks.groupBy("db_id").agg(F.count("*").alias("total_foreign_keys"))
    zero = F.lit(0).cast("bigint")
    totals = (
        per_table.join(per_column, "db_id", "left").join(per_fk, "db_id", "left")
        .select(
            "db_id", "table_count",
            F.coalesce("total_columns", zero).alias("total_columns"),
            F.coalesce("total_foreign_keys", zero).alias("total_foreign_keys"),
            F.coalesce("total_rows", zero).alias("total_rows"),
        )
    )
    return with_complexity(totals)


# Weights of the complexity score.
TABLE_WEIGHT, COLUMN_WEIGHT, FOREIGN_KEY_WEIGHT = 1.0, 0.1, 2.0


def with_complexity(totals: DataFrame) -> DataFrame:
    return totals.withColumn(
        "complexity_score",
        F.col("table_count") * F.lit(TABLE_WEIGHT)
        + F.col("total_columns") * F.lit(COLUMN_WEIGHT)
        + F.col("total_foreign_keys") * F.lit(FOREIGN_KEY_WEIGHT),
    )


def domain_summary(databases: DataFrame, descriptions: dict[str, str] = DOMAIN_DESCRIPTIONS) -> DataFrame:
    """Per domain that has databases; the member ids are the rows of `domain_members`.

    databases: (db_id, domain, table_count, total_rows, complexity_score).
    """
    described = F
    for domain, text in descriptions.items():
        described = described.when(F.col("domain") == domain, F.lit(text))
    return (
        databases.groupBy("domain")
        .agg(
            F.count("*").alias("count"),
            F.avg("complexity_score").alias("avg_complexity"),
            F.sum("table_count").alias("total_tables"),
            F.sum("total_rows").alias("total_rows"),
        )
        .withColumn("description", described.otherwise(F.lit("")))
    )


def domain_members(databases: DataFrame) -> DataFrame:
    """(domain, db_id): the id list of a domain as rows, so that no list outgrows a task."""
    return databases.select("domain", "db_id")


def complexity_range(databases: DataFrame) -> DataFrame:
    """One row; the smallest db_id among equal scores, zeros and nulls when empty."""
    score, zero = F.col("complexity_score"), F.lit(0.0)
    return databases.agg(
        F.coalesce(F.min(score), zero).alias("min_complexity"),
        F.coalesce(F.max(score), zero).alias("max_complexity"),
        F.coalesce(F.avg(score), zero).alias("avg_complexity"),
        F.min(F.struct((-score).alias("s"), F.col("db_id")))["db_id"].alias("most_complex"),
        F.min(F.struct(score.alias("s"), F.col("db_id")))["db_id"].alias("least_complex"),
    )
