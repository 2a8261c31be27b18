"""Text measures used by the views and reports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def token_count(text: Column, token: str) -> Column:
    """Non-overlapping, case-sensitive occurrences of `token`, as a double."""
    return (F.length(text) - F.length(F.replace(text, F.lit(token), F.lit("")))) / F.lit(len(token))


def truncated(text: Column, size: int) -> Column:
    return F.substring(text, 1, size)


def has_any(text: Column, *tokens: str) -> Column:
    """True where one of the tokens is a substring, case-sensitive."""
    condition = text.contains(tokens[0])
    for token in tokens[1:]:
        condition = condition | text.contains(token)
    return condition


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def percentage(part: Column, whole: Column) -> Column:
    """part / whole * 100 as double, null where `whole` is zero."""
    return F.try_divide(part.cast("double"), whole) * F.lit(100)


def exact_average(value: Column, scale: int = 2) -> Column:
    """Average of a money column, summed as decimal so that it does not depend on order."""
    return F.sum(value.cast(f"decimal(18,{scale})")).cast("double") / F.count(value)


def exact_sum(value: Column, scale: int = 2) -> Column:
    return F.sum(value.cast(f"decimal(18,{scale})")).cast("double")
