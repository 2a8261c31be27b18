"""Analysis views over questions, databases, schemas, foreign keys and the load state.

Each function returns the rows of the view; order is the reader's choice.
Facts are aggregated per database before they meet the databases table, so the
join sees one row per database however many facts a single database holds, and
Spark picks broadcast or shuffle from the measured size of the two sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakecat.functions.text import count_where, has_any, percentage, token_count

# Difficulties that count as complex, and the length from which on a statement does.
HARD_LEVELS = ["hard", "extra_hard"]
LONG_SQL = 200

FACTS_PER_TASK = 1_000_000  # foreign keys that one task folds


def summary(questions: DataFrame) -> DataFrame:
    return questions.groupBy("domain").agg(
        F.count("*").alias("question_count"),
        F.countDistinct("db_id").alias("database_count"),
        F.avg(F.length("question")).alias("avg_question_length"),
        F.avg(F.length("sql_query")).alias("avg_sql_length"),
    )


def complex_questions(questions: DataFrame, levels: list[str] = HARD_LEVELS,
                      longer_than: int = LONG_SQL, token: str = "JOIN") -> DataFrame:
    length = F.length("sql_query")
    return questions.filter(F.col("difficulty").isin(levels) | (length > longer_than)).select(
        "id", "db_id", "question", "difficulty",
        length.cast("bigint").alias("sql_length"),
        token_count(F.col("sql_query"), token).alias("join_count"),
    )


def domain_complexity(questions: DataFrame, join_tokens: tuple[str, ...] = ("JOIN",),
                      subquery_tokens: tuple[str, ...] = ("SUBQUERY", "(")) -> DataFrame:
    sql = F.col("sql_query")
    return questions.groupBy("domain").agg(
        F.avg(F.length(sql)).alias("avg_sql_complexity"),
        count_where(has_any(sql, *join_tokens)).alias("join_questions"),
        count_where(has_any(sql, *subquery_tokens)).alias("subquery_questions"),
        F.count("*").alias("total_questions"),
    )


def join_percentage(complexity: DataFrame) -> DataFrame:
    return complexity.select(
        "domain", "join_questions", "total_questions",
        percentage(F.col("join_questions"), F.col("total_questions")).alias("join_percentage"),
    )


def comprehensive_summary(questions: DataFrame, databases: DataFrame) -> DataFrame:
    """Per domain; table totals and sizes weigh each database by its questions."""
    per_database = questions.groupBy("db_id").agg(
        F.count("*").alias("n"),
        F.count("id").alias("n_id"),
        F.sum(F.length("question")).alias("question_chars"),
        F.count("question").alias("n_question"),
        F.sum(F.length("sql_query")).alias("sql_chars"),
        F.count("sql_query").alias("n_sql"),
    )
    joined = per_database.join(databases.select("db_id", "domain", "num_tables", "size_mb"), "db_id")
    weighted_size = F.sum(F.col("size_mb") * F.col("n")).cast("double")
    sized = F.sum(F.when(F.col("size_mb").isNotNull(), F.col("n")))
    return joined.groupBy("domain").agg(
        F.countDistinct("db_id").alias("database_count"),
        F.sum("n_id").alias("question_count"),
        _ratio("question_chars", "n_question").alias("avg_question_length"),
        _ratio("sql_chars", "n_sql").alias("avg_sql_length"),
        F.sum(F.col("num_tables") * F.col("n")).cast("bigint").alias("total_tables"),
        F.try_divide(weighted_size, sized).alias("avg_db_size_mb"),
    )


def _ratio(total: str, count: str) -> Column:
    return F.try_divide(F.sum(total).cast("double"), F.sum(count))


def schema_overview(schemas: DataFrame, databases: DataFrame) -> DataFrame:
    per_database = schemas.groupBy("db_id").agg(
        F.countDistinct("table_name").alias("tables"),
        F.count("column_name").alias("columns"),
        count_where(F.col("is_primary_key")).alias("pks"),
        count_where(F.col("is_foreign_key")).alias("fks"),
    )
    return per_database.join(databases.select("db_id", "domain"), "db_id").groupBy("db_id", "domain").agg(
        F.max("tables").alias("table_count"),
        F.sum("columns").alias("total_columns"),
        F.sum("pks").alias("primary_key_columns"),
        F.sum("fks").alias("foreign_key_columns"),
    )


def data_availability(table_info: DataFrame, databases: DataFrame) -> DataFrame:
    """Per database; pass `row_count` as decimal when the total must not depend on order."""
    per_database = table_info.groupBy("db_id").agg(
        F.count("*").alias("tables"),
        count_where(F.col("data_loaded")).alias("loaded"),
        F.sum("row_count").alias("rows"),
        F.count("row_count").alias("n_rows"),
    )
    return per_database.join(databases.select("db_id", "domain"), "db_id").groupBy("db_id", "domain").agg(
        F.sum("tables").alias("total_tables"),
        F.sum("loaded").alias("tables_loaded"),
        F.sum("rows").alias("total_rows"),
        _ratio("rows", "n_rows").alias("avg_rows_per_table"),
    )


def relationship_complexity(foreign_keys: DataFrame, databases: DataFrame) -> DataFrame:
    """Per database; the facts are counted, so that a task folds as many of them however many there are."""
    tasks = max(1, -(-foreign_keys.count() // FACTS_PER_TASK))
    keys = ["db_id", "source_table", "target_table"]
    # Folded first: the two sides of a pair are then counted over folded rows, not facts.
    pairs = foreign_keys.select(*keys).repartition(tasks, *keys).groupBy(*keys).agg(F.count("*").alias("n"))
    sides = pairs.unpivot(["db_id", "n"], ["source_table", "target_table"], "side", "name")
    names = sides.repartition(2 * tasks, "db_id", "side", "name").groupBy("db_id", "side", "name").agg(F.sum("n").alias("n"))
    is_source = F.col("side") == "source_table"
    per_database = names.groupBy("db_id").agg(
        F.sum(F.when(is_source, F.col("n"))).alias("n"),
        F.count(F.when(is_source, F.col("name"))).alias("sources"),
        F.count(F.when(~is_source, F.col("name"))).alias("targets"),
    )
    return per_database.join(databases.select("db_id", "domain"), "db_id").groupBy("db_id", "domain").agg(
        F.sum("n").alias("foreign_key_count"),
        F.max("sources").alias("tables_with_fks"),
        F.max("targets").alias("referenced_tables"),
    )


def test_summary(questions: DataFrame, first: int = 5) -> DataFrame:
    """First `first` databases in id order, with length averages."""
    return (
        questions.filter(F.col("db_id").isNotNull())
        .groupBy("db_id")
        .agg(
            F.min("domain").alias("domain"),
            F.count("*").alias("question_count"),
            F.avg(F.length("question")).alias("avg_question_length"),
        )
        .orderBy("db_id")
        .limit(first)
        .select("domain", "question_count", "avg_question_length")
    )


def publish(views: dict[str, DataFrame]) -> list[str]:
    """Create or replace a temporary view per entry; returns the names."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def publish_all(questions: DataFrame, databases: DataFrame, schemas: DataFrame,
                foreign_keys: DataFrame, table_info: DataFrame, prefix: str = "lake") -> list[str]:
    return publish({
        f"{prefix}_summary": summary(questions),
        f"{prefix}_complex_questions": complex_questions(questions),
        f"{prefix}_domain_complexity": domain_complexity(questions),
        f"{prefix}_comprehensive_summary": comprehensive_summary(questions, databases),
        f"{prefix}_schema_overview": schema_overview(schemas, databases),
        f"{prefix}_data_availability": data_availability(table_info, databases),
        f"{prefix}_relationship_complexity": relationship_complexity(foreign_keys, databases),
    })


def read_view(spark: SparkSession, name: str, order: list[Column] | None = None,
              limit: int | None = None) -> DataFrame:
    df = spark.table(name)
    if order:
        df = df.orderBy(*order)
    return df.limit(limit) if limit else df
