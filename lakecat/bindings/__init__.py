"""The library's operators bound to the driver's tables, each with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under `name`, with its SQL where there is one."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = oracle
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def register_all() -> None:
    """Import the modules that register queries."""
    from lakecat.bindings import catalog, labels, load, reports, sources, texts, views  # noqa: F401
