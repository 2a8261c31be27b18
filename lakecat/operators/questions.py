"""Benchmark records to the questions table, and the databases they name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakecat.functions.domains import first_match
from lakecat.functions.naming import original_id, padded_id
from lakecat.functions.rules import FULL_RULES, Rules
from lakecat.functions.text import truncated

# Record fields of the two question sources, first present one wins.
DEV_FIELDS = {
    "db_id": ["db_id"],
    "question": ["question"],
    "evidence": ["evidence"],
    "sql_query": ["SQL"],
    "difficulty": ["difficulty"],
    "question_id_original": ["question_id"],
}
FLASH_FIELDS = {
    "db_id": ["db_id"],
    "question": ["query"],
    "evidence": [],
    "sql_query": ["clean_up_sql", "preprocess_sql"],
    "difficulty": ["difficulty_tier"],
    "question_id_original": ["instance_id"],
}
FIELD_DEFAULTS = {"difficulty": "unknown"}


def first_present(df: DataFrame, names: list[str], default: Column) -> Column:
    """The first of `names` that is a column, nulls kept; `default` if none is."""
    for name in names:
        if name in df.columns:
            return F.col(name)
    return default


def normalise_questions(records: DataFrame, fields: dict[str, list[str]] = DEV_FIELDS, *,
                        rules: Rules = FULL_RULES, id_prefix: str = "lake", id_width: int = 6,
                        default_db_id: str = "", question_chars: int | None = None,
                        sql_chars: int | None = None) -> DataFrame:
    """Records with a dense `pos` to the questions schema, in one projection."""
    position = F.col("pos")
    columns = {}
    for target, names in fields.items():
        if target == "question_id_original":
            default = original_id(position)
        elif target == "db_id":
            default = F.lit(default_db_id)
        else:
            default = F.lit(FIELD_DEFAULTS.get(target, ""))
        columns[target] = first_present(records, names, default).cast("string")
    if question_chars:
        columns["question"] = truncated(columns["question"], question_chars)
    if sql_chars:
        columns["sql_query"] = truncated(columns["sql_query"], sql_chars)
    return records.select(
        padded_id(position, id_prefix, id_width).alias("id"),
        *[columns[name].alias(name) for name in ("db_id", "question", "evidence", "sql_query", "difficulty")],
        first_match(columns["db_id"], rules).alias("domain"),
        columns["question_id_original"].alias("question_id_original"),
    )


def questions_from(splits: dict[str, DataFrame], **options) -> DataFrame:
    """The dev split where it exists, the flash split with its own fields otherwise."""
    if "mini_dev_sqlite" in splits:
        return normalise_questions(splits["mini_dev_sqlite"], DEV_FIELDS, **options)
    return normalise_questions(splits["flash"], FLASH_FIELDS, **options)


def positional_slice(records: DataFrame, n: int, limit: int | None = None) -> DataFrame:
    """The first `n` records by `pos`; a `limit` inside the slice lowers it further."""
    return records.orderBy("pos").limit(n if limit is None else min(n, limit))


def databases_of(questions: DataFrame, rules: Rules = FULL_RULES, description: str = "Benchmark database: ",
                 ) -> DataFrame:
    """Distinct non-empty database ids with the position they first appear at."""
    return (
        questions.filter(F.col("db_id") != "")
        .groupBy("db_id")
        .agg(F.min("pos").alias("first_pos"))
        .select(
            "db_id",
            F.col("db_id").alias("db_name"),
            first_match(F.col("db_id"), rules).alias("domain"),
            F.lit(0).cast("bigint").alias("num_tables"),
            F.concat(F.lit(description), F.col("db_id")).alias("description"),
            F.lit(0.0).alias("size_mb"),
            "first_pos",
        )
    )
