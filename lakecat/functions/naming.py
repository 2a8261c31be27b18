"""Ids and names of records, tables, columns and files."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, functions as F


def padded_id(position: Column, prefix: str, width: int) -> Column:
    """`prefix_000042`: zero-padded, never cut when the number is wider."""
    return F.format_string(f"{prefix}_%0{width}d", position)


def original_id(position: Column) -> Column:
    return F.format_string("q_%d", position)


def record_id(*parts: Column) -> Column:
    """Parts joined by `_`, null when a part is null."""
    joined = parts[0]
    for part in parts[1:]:
        joined = F.concat(joined, F.lit("_"), part)
    return joined


def target_table_name(db_id: Column, table_name: Column, prefix: str = "LAKE") -> Column:
    return F.upper(record_id(F.lit(prefix), db_id, table_name))


def clean_file_id(db_id: Column) -> Column:
    """Letters and digits of any script, `_` and `-`; everything else dropped."""
    return F.regexp_replace(db_id, r"[^\p{L}\p{N}_-]", "")


def colliding_ids(ids: DataFrame, column: str = "db_id") -> DataFrame:
    """Distinct ids that clean to one file name: (file_id, n_ids, first_id, last_id)."""
    cleaned = ids.select(clean_file_id(F.col(column)).alias("file_id"), F.col(column).alias("id")).distinct()
    return (
        cleaned.groupBy("file_id")
        .agg(F.count("*").alias("n_ids"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))
        .filter(F.col("n_ids") > 1)
    )


def normalised(name: str) -> str:
    return name.upper().replace(" ", "_").replace("-", "_")


def _renamed(names: Iterable[str], rename: Callable[[str], str]) -> list[str]:
    names = list(names)
    out = [rename(name) for name in names]
    by_new: dict[str, list[str]] = {}
    for old, new in zip(names, out):
        by_new.setdefault(new, []).append(old)
    clashes = {new: olds for new, olds in by_new.items() if len(olds) > 1}
    if clashes:
        raise ValueError(f"column names collide after renaming: {clashes}")
    return out


def normalised_names(names: Iterable[str]) -> list[str]:
    return _renamed(names, normalised)


def normalise_columns(df: DataFrame) -> DataFrame:
    """Upper-case column names with blank and `-` as `_`; raises on a collision."""
    return df.toDF(*normalised_names(df.columns))


def upper_names(names: Iterable[str]) -> list[str]:
    return _renamed(names, str.upper)


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*upper_names(df.columns))
