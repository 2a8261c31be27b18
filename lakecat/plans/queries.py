"""Reports over questions, the catalog and loaded tables.

Column names are arguments; each function states one query shape. Detail rows are
reduced per key before a join wherever the aggregate allows it, so that a key with
very many rows is folded on the map side. Ordered limits carry a unique tie-break.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakecat.functions.text import count_where, truncated


def total(df: DataFrame, out: str) -> DataFrame:
    return df.agg(F.count("*").alias(out))


def distinct_total(df: DataFrame, column: str, out: str) -> DataFrame:
    return df.agg(F.countDistinct(column).alias(out))


def total_where(df: DataFrame, condition: Column, out: str) -> DataFrame:
    return df.agg(count_where(condition).alias(out))


def counts_by(df: DataFrame, key: str, out: str = "count") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias(out))


def most_frequent(df: DataFrame, key: str, n: int, out: str = "count") -> DataFrame:
    return counts_by(df, key, out).orderBy(F.desc(out), key).limit(n)


def counts_by_difficulty(questions: DataFrame) -> DataFrame:
    return counts_by(questions.filter(F.col("difficulty").isNotNull()), "difficulty")


def sql_length_by_difficulty(questions: DataFrame) -> DataFrame:
    return (
        questions.filter(F.col("difficulty").isNotNull())
        .groupBy("difficulty")
        .agg(F.count("*").alias("count"), F.avg(F.length("sql_query")).alias("avg_sql_length"))
    )


def questions_by_domain(questions: DataFrame, n: int = 5) -> DataFrame:
    return (
        questions.groupBy("domain")
        .agg(F.count("*").alias("question_count"), F.avg(F.length("question")).alias("avg_question_length"))
        .orderBy(F.desc("question_count"), "domain")
        .limit(n)
    )


def databases_by_domain(databases: DataFrame) -> DataFrame:
    return databases.groupBy("domain").agg(
        F.count("*").alias("database_count"),
        F.sum("num_tables").cast("bigint").alias("total_tables"),
        F.try_divide(F.sum("size_mb").cast("double"), F.count("size_mb")).alias("avg_size_mb"),
    )


def tables_by_database(databases: DataFrame) -> DataFrame:
    return databases.select("db_id", "num_tables", "description").orderBy(F.desc("num_tables"), "db_id")


def preview(questions: DataFrame, n: int = 3, size: int = 100) -> DataFrame:
    return (
        questions.orderBy("id").limit(n)
        .select("id", "db_id", truncated(F.col("question"), size).alias("question_preview"))
    )


def sample(df: DataFrame, key: str, n: int = 3, columns: list[str] | None = None) -> DataFrame:
    first = df.orderBy(key).limit(n)
    return first.select(*columns) if columns else first


def where_limited(df: DataFrame, condition: Column, key: str, n: int, columns: list[str]) -> DataFrame:
    return df.filter(condition).orderBy(key).limit(n).select(*columns)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count), one row per table; Parquet answers from footers."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def sum_by(df: DataFrame, key: str, value: Column, out: str) -> DataFrame:
    return df.groupBy(key).agg(F.sum(value).cast("double").alias(out))


def sum_where(df: DataFrame, condition: Column, value: Column, out: str) -> DataFrame:
    return df.filter(condition).agg(F.sum(value).cast("double").alias(out))


def joined_top(left: DataFrame, right: DataFrame, on: str, order: list[Column], n: int,
               columns: list[str]) -> DataFrame:
    """Rows of the inner join, first `n` in `order` (columns of `right` that end in a unique key).

    Only keys of `left` meet all of `right`; its other columns are fetched for the first rows.
    """
    top = right.join(left.select(on), on, "left_semi").orderBy(*order).limit(n)
    return left.join(top, on).orderBy(*order).limit(n).select(*columns)


def left_counts(left: DataFrame, right: DataFrame, on: str, counted: str, out: str) -> DataFrame:
    """Every left row with its number of non-null `counted`; zero without a match."""
    per_key = right.groupBy(on).agg(F.count(counted).alias(out))
    return left.join(per_key, on, "left").withColumn(out, F.coalesce(out, F.lit(0).cast("bigint")))


def chain_summary(customers: DataFrame, accounts: DataFrame, transactions: DataFrame,
                  names: list[str], amount: Column) -> DataFrame:
    """Per customer: number of transactions, their sum and average, over the inner chain.

    customers(customer_id, names...), accounts(account_id, customer_id),
    transactions(account_id, ...). Transactions fold per account, accounts per
    customer, so the joins move one row per key.
    """
    per_account = transactions.groupBy("account_id").agg(
        F.count("*").alias("n"), F.sum(amount).alias("s"), F.count(amount).alias("n_amount"))
    per_customer = (
        accounts.select("account_id", "customer_id").join(per_account, "account_id")
        .groupBy("customer_id")
        .agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("n_amount").alias("n_amount"))
    )
    return customers.select("customer_id", *names).join(per_customer, "customer_id").select(
        "customer_id", *names,
        F.col("n").alias("transaction_count"),
        F.col("s").cast("double").alias("total_amount"),
        F.try_divide(F.col("s").cast("double"), F.col("n_amount")).alias("avg_amount"),
    )


def having_both(customers: DataFrame, accounts: DataFrame, kind: str, first: str, second: str,
                names: list[str]) -> DataFrame:
    """Customers with an account of each kind, by one pass over the accounts."""
    both = (
        accounts.filter(F.col(kind).isin(first, second))
        .groupBy("customer_id")
        .agg(F.max(F.col(kind) == first).alias("has_first"), F.max(F.col(kind) == second).alias("has_second"))
        .filter(F.col("has_first") & F.col("has_second"))
    )
    return customers.join(both, "customer_id", "left_semi").select("customer_id", *names).distinct()


def best_of(df: DataFrame, name: str, values: list[str], order: list[Column], columns: list[str]) -> DataFrame:
    return df.filter(F.col(name).isin(values)).orderBy(*order).limit(1).select(*columns)


def loaded_rows_by_database(table_info: DataFrame) -> DataFrame:
    return table_info.filter(F.col("data_loaded")).groupBy("db_id").agg(
        F.count("*").alias("table_count"), F.sum("row_count").alias("total_rows"))
