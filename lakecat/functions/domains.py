"""Domain labels from names: first match in rule order, or highest score."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lakecat.functions.matching import all_words, hit_count, name_hits, text_hits
from lakecat.functions.rules import (
    COLUMN_KEYWORD_POINTS,
    DEFAULT_DOMAIN,
    ID_KEYWORD_POINTS,
    SCORED_KEYWORDS,
    SCORED_TABLE_PATTERNS,
    TABLE_KEYWORD_POINTS,
    TABLE_PATTERN_POINTS,
    Rules,
)


def _any_of(lowered: Column, words: list[str]) -> Column:
    return reduce(Column.__or__, [lowered.contains(word) for word in words])


def first_match(name: Column, rules: Rules, default: str = DEFAULT_DOMAIN) -> Column:
    """The first domain with a keyword inside `name`, case-insensitive."""
    lowered = F.lower(name)
    label = F
    for domain, words in rules.items():
        label = label.when(_any_of(lowered, words), F.lit(domain))
    return label.otherwise(F.lit(default))


def with_first_match(df: DataFrame, name: str, rules: Rules, out: str = "domain") -> DataFrame:
    """`df` with a label column; lowers the name once, below the rule chain."""
    lowered = df.withColumn("_lowered", F.lower(F.col(name)))
    return lowered.withColumn(out, first_match(F.col("_lowered"), rules)).drop("_lowered")


def _best(domains: list[str], score: Column, minus_place: Column) -> Column:
    return F.when(score > 0, F.get(F.lit(domains), -minus_place)).otherwise(F.lit(DEFAULT_DOMAIN))


def _with_scores(df: DataFrame, hits: Column, keywords: Rules, out: str, score: str) -> DataFrame:
    """Highest score over the hits, the earlier domain on equal scores; a projection, no shuffle."""
    kept, words = df.columns, all_words(keywords)
    counted = F.array(*[
        F.struct(hit_count(F.col("_hits"), words, own).alias("n"), F.lit(-place).alias("minus_place"))
        for place, own in enumerate(keywords.values())])
    found = df.select(*kept, F.coalesce(hits, F.lit([]).cast("array<int>")).alias("_hits"))
    best = found.select(*kept, F.array_max(counted).alias("_best"))
    return best.select(
        *kept,
        _best(list(keywords), F.col("_best.n"), F.col("_best.minus_place")).alias(out),
        (F.col("_best.n") * F.lit(ID_KEYWORD_POINTS)).cast("bigint").alias(score))


def with_scored_label(df: DataFrame, name: str, keywords: Rules = SCORED_KEYWORDS,
                      out: str = "domain", score: str = "score") -> DataFrame:
    """Score one column of names against every keyword."""
    lowered = df.withColumn("_lowered", F.lower(F.col(name)))
    hits = name_hits(F.col("_lowered"), all_words(keywords))
    return _with_scores(lowered, hits, keywords, out, score).drop("_lowered")


def with_scored_text(df: DataFrame, text: str, keywords: Rules = SCORED_KEYWORDS,
                     out: str = "domain", score: str = "score") -> DataFrame:
    """As `with_scored_label`, for long texts: one pass over each for all keywords."""
    return _with_scores(df, text_hits(F.lower(F.col(text)), all_words(keywords)), keywords, out, score)


def catalog_names(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """(db_id, kind, name): each database once, each table, each column.

    `tables` has (db_id, table_name), `columns` has (db_id, column_name).
    """
    databases = tables.select("db_id").distinct()
    return (
        databases.select("db_id", F.lit("database").alias("kind"), F.col("db_id").alias("name"))
        .unionByName(tables.select("db_id", F.lit("table").alias("kind"), F.col("table_name").alias("name")))
        .unionByName(columns.select("db_id", F.lit("column").alias("kind"), F.col("column_name").alias("name")))
    )


def scored_catalog_labels(names: DataFrame, keywords: Rules = SCORED_KEYWORDS,
                          patterns: Rules = SCORED_TABLE_PATTERNS) -> DataFrame:
    """(db_id, domain, score) from all names of a database.

    Every name yields its matches; their points are summed per database and domain
    before the shuffle, so a database with very many columns stays cheap.
    """
    domains = list(keywords)
    own = [(place, word) for place, domain in enumerate(domains) for word in keywords[domain]]
    of_tables = [(place, word) for place, domain in enumerate(domains) for word in patterns.get(domain, [])]
    words = [word for _, word in own + of_tables]
    places = F.lit([place for place, _ in own + of_tables])
    lowered = names.select("db_id", "kind", F.lower("name").alias("name"))
    matches = lowered.select("db_id", "kind", F.explode_outer(name_hits(F.col("name"), words)).alias("hit"))
    keyword_points = (
        F.when(F.col("kind") == "database", F.lit(ID_KEYWORD_POINTS))
        .when(F.col("kind") == "table", F.lit(TABLE_KEYWORD_POINTS))
        .otherwise(F.lit(COLUMN_KEYWORD_POINTS)))
    pattern_points = F.when(F.col("kind") == "table", F.lit(TABLE_PATTERN_POINTS)).otherwise(F.lit(0))
    scores = (
        matches.select(
            "db_id", F.get(places, F.col("hit")).alias("place"),
            F.when(F.col("hit") < len(own), keyword_points).otherwise(pattern_points).alias("points"))
        .groupBy("db_id", "place").agg(F.sum("points").alias("score"))
    )
    scored = F.when(F.col("place").isNotNull() & (F.col("score") > 0), F.struct("score", (-F.col("place")).alias("minus_place")))
    best = scores.groupBy("db_id").agg(F.max(scored).alias("best"))
    return best.select(
        "db_id",
        _best(domains, F.col("best.score"), F.col("best.minus_place")).alias("domain"),
        F.coalesce("best.score", F.lit(0)).cast("bigint").alias("score"),
    )
