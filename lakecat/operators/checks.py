"""Checks of a load: key uniqueness and the fixed report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakecat.functions.text import count_where
from lakecat.schemas import PRIMARY_KEYS


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values held by more than one row, and keys with a null, with their counts."""
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter((F.col("n") > 1) | has_null)


def key_check(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: distinct keys, duplicated keys, rows with a null key."""
    null_key = F.lit(False)
    for key in keys:
        null_key = null_key | F.col(key).isNull()
    return df.groupBy(*keys).agg(F.count("*").alias("n")).agg(
        count_where(~null_key).alias("distinct_keys"),
        count_where((F.col("n") > 1) & ~null_key).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(null_key, F.col("n"))), F.lit(0)).alias("null_key_rows"),
    )


def metadata_key_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, distinct_keys, duplicate_keys, null_key_rows) of every metadata table that declares a key."""
    return reduce(DataFrame.unionByName, [
        key_check(tables[name], keys).withColumn("table_name", F.lit(name)) for name, keys in PRIMARY_KEYS.items()
        if name in tables])


def check_rows(df: DataFrame, checks: dict[str, tuple[Column, Column]]) -> DataFrame:
    """(check, value, ok) of several global aggregates, by one pass over `df`.

    `checks` maps a name to (aggregate, condition over `F.col("value")`).
    """
    aliases = {name: f"c{i}" for i, name in enumerate(checks)}
    one_row = df.agg(*[checks[name][0].cast("bigint").alias(alias) for name, alias in aliases.items()])
    entries = [F.struct(F.lit(name).alias("check"), F.col(alias).alias("value")) for name, alias in aliases.items()]
    rows = one_row.select(F.inline(F.array(*entries)))
    ok = F
    for name, (_, condition) in checks.items():
        ok = ok.when(F.col("check") == name, condition)
    return rows.withColumn("ok", F.coalesce(ok.otherwise(F.lit(False)), F.lit(False)))


def checks_by_table(questions: DataFrame | None = None, databases: DataFrame | None = None,
                    schemas: DataFrame | None = None, foreign_keys: DataFrame | None = None,
                    table_info: DataFrame | None = None) -> dict[str, DataFrame]:
    """The checks of a full load, one DataFrame (check, value, ok) per table that is there."""
    some, none, any_number = F.col("value") > 0, F.col("value") == 0, F.col("value") >= 0
    planned = {
        "questions": (questions, {
            "total_questions": (F.count("*"), some),
            "question_databases": (F.countDistinct("db_id"), some),
            "questions_without_sql": (count_where(F.coalesce("sql_query", F.lit("")) == ""), none),
        }),
        "databases": (databases, {
            "unique_databases": (F.countDistinct("db_id"), some),
            "database_records": (F.count("*"), some),
        }),
        "table_schemas": (schemas, {"schema_records": (F.count("*"), some)}),
        "foreign_keys": (foreign_keys, {"foreign_key_relationships": (F.count("*"), any_number)}),
        "table_data_info": (table_info, {
            "tables_with_data": (count_where(F.col("data_loaded")), some),
            "tables_without_data": (count_where(~F.col("data_loaded")), none),
        }),
    }
    return {name: check_rows(df, checks) for name, (df, checks) in planned.items() if df is not None}


def load_checks(**tables: DataFrame) -> DataFrame:
    """All checks of a full load as one DataFrame; arguments as `checks_by_table`."""
    return reduce(DataFrame.unionByName, checks_by_table(**tables).values())


def run_load_checks(spark: SparkSession, **tables: DataFrame) -> DataFrame:
    """(table, check, value, ok, error): a table whose checks fail to run is a row, not an abort.

    Results are a handful of rows per table.
    """
    out = []
    for name, checks in checks_by_table(**tables).items():
        try:
            out += [(name, row["check"], row["value"], row["ok"], None) for row in checks.collect()]
        except Exception as error:
            out.append((name, None, None, False, str(error)))
    return spark.createDataFrame(out, "table string, check string, value bigint, ok boolean, error string")
