"""Declared column types to target types, and target types to Spark types."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F, types as T

TEXT_TYPE = "VARCHAR(16777216)"

# The first key inside the upper-cased declared type decides.
PLAIN_MAP = {
    "INTEGER": "INTEGER",
    "TEXT": TEXT_TYPE,
    "REAL": "FLOAT",
    "NUMERIC": "NUMERIC(38,2)",
    "BLOB": "VARIANT",
}

# As above, tried after the declared sizes that pass through.
SIZED_MAP = {
    "INTEGER": "INTEGER",
    "TEXT": TEXT_TYPE,
    "VARCHAR": TEXT_TYPE,
    "REAL": "FLOAT",
    "DECIMAL": "DECIMAL(15,2)",
    "DATE": "DATE",
    "DATETIME": "TIMESTAMP",
    "TIMESTAMP": "TIMESTAMP",
}
SIZED_PASS_THROUGH = ["VARCHAR(", "DECIMAL("]


def _mapped(declared: Column, mapping: dict[str, str], pass_through: list[str] = ()) -> Column:
    upper = F.upper(declared)
    target = F
    for part in pass_through:
        target = target.when(upper.contains(part), declared)
    for key, value in mapping.items():
        target = target.when(upper.contains(key), F.lit(value))
    return target.otherwise(F.lit(TEXT_TYPE))


def plain_type(declared: Column) -> Column:
    return _mapped(declared, PLAIN_MAP)


def sized_type(declared: Column) -> Column:
    return _mapped(declared, SIZED_MAP, SIZED_PASS_THROUGH)


def stored_type(kinds: Column, whole: Column | None = None, scale: Column | None = None) -> Column:
    """The type that holds all values of a column as they are stored, by the kinds of values it has (a sum of
    1 integer, 2 real, 4 text, 8 blob, 16 integer beyond 2 ** 53).

    Integers beside reals become doubles while every integer is one; with larger ones, a decimal with as many digits
    before and after the point (`whole`, `scale`) as they need, or text where no decimal is wide enough. Any other mixture is text: a
    text that reads as a number or a date stays what it is, since "007" or "1e3" would not come back.
    """
    double = kinds.isin(2, 3)
    mapped = F.when(kinds.isin(1, 17), F.lit("INTEGER")).when(double, F.lit("FLOAT")).when(kinds == 8, F.lit("VARIANT"))
    if whole is not None:
        fits = (kinds == 19) & (F.greatest(whole, F.lit(0)) + scale <= 38)
        mapped = mapped.when(fits, F.format_string("DECIMAL(38,%d)", scale))
    return mapped.otherwise(F.lit(TEXT_TYPE))


TYPE_MAPS = {"plain": plain_type, "sized": sized_type}

_SPARK_TYPES = {
    "INTEGER": T.LongType(),
    "FLOAT": T.DoubleType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "BOOLEAN": T.BooleanType(),
    "VARIANT": T.BinaryType(),
}
_SIZED_DECIMAL = re.compile(r"(?:DECIMAL|NUMERIC)\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)")


def spark_type(target: str) -> T.DataType:
    """Spark type of a target type; text, which loses nothing, where Spark has no such decimal."""
    upper = target.upper().strip()
    if upper in _SPARK_TYPES:
        return _SPARK_TYPES[upper]
    decimal = _SIZED_DECIMAL.search(upper)
    if decimal:
        precision, scale = int(decimal[1]), int(decimal[2] or 0)
        if 0 < precision <= 38 and scale <= precision:
            return T.DecimalType(precision, scale)
    return T.StringType()
