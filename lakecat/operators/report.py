"""The mapping report as JSON: domains, complexity, databases."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakecat.operators.catalog import complexity_range, domain_members, domain_summary
from lakecat.session import written


def database_list(databases: DataFrame, tables: DataFrame) -> DataFrame:
    """Databases with their table names; one file's table list bounds the array."""
    names = tables.groupBy("db_id").agg(F.array_sort(F.collect_list("table_name")).alias("tables"))
    return databases.join(names, "db_id", "left").select(
        "db_id", "domain", "table_count", "total_columns", "total_foreign_keys", "total_rows",
        "complexity_score", F.coalesce("tables", F.array().cast("array<string>")).alias("tables"))


def report_parts(databases: DataFrame, tables: DataFrame, found: DataFrame | None = None) -> dict[str, DataFrame]:
    """The sections of the report; lists that grow with the lake are rows.

    The total counts `found`, all files of a lake, readable or not; without it the databases.
    """
    return {
        "domain_summary": domain_summary(databases),
        "domain_members": domain_members(databases),
        "complexity_analysis": complexity_range(databases),
        "total_databases": (databases if found is None else found).agg(F.count("*").alias("total_databases")),
        "database_list": database_list(databases, tables),
    }


def write_report(databases: DataFrame, tables: DataFrame, path: str, found: DataFrame | None = None) -> list[str]:
    """One folder of JSON lines per section, null fields written out."""
    parts = report_parts(written(databases, "report_databases"), tables, found)
    for name, df in parts.items():
        df.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/{name}")
    return list(parts)
