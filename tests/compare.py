"""Run registered queries in Spark and their SQL in DuckDB, and compare the rows."""

import datetime
import decimal
import math

import duckdb


def connect(folder, tables):
    db = duckdb.connect()
    for name in tables:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return value


def sort_key(row):
    return tuple((v is None, type(v).__name__ if not isinstance(v, (int, float)) else "n", v if v is not None else 0)
                 for v in row)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=sort_key)


def same(name, spark_df, db, sql):
    spark_columns, spark_rows = normal(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = db.execute(sql)
    duck_columns, duck_rows = normal([d[0] for d in cursor.description], cursor.fetchall())
    if spark_columns != duck_columns:
        return f"columns {spark_columns} != {duck_columns}"
    if len(spark_rows) != len(duck_rows):
        return f"rows {len(spark_rows)} != {len(duck_rows)}"
    for mine, theirs in zip(spark_rows, duck_rows):
        for column, a, b in zip(spark_columns, mine, theirs):
            if type(a) is not type(b) and not (isinstance(a, (int, float)) and isinstance(b, (int, float))):
                return f"{column}: type {a!r} != {b!r}"
            if a != b and not (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b)):
                return f"{column}: {str(a)[:200]!r} != {str(b)[:200]!r}"
    return None
