"""Dense 0-based positions without a global window."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from lakecat.session import shared_folder

ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below
ROWS_PER_RANGE = 2_000_000


def with_positions(df: DataFrame, block: list[str], row: str, out: str = "pos") -> DataFrame:
    """Number rows that already carry a consecutive `row` number within each `block`.

    Blocks follow each other in the order of their columns. Only one small row per
    block is ordered globally; the data itself is not sorted, and not shuffled either
    while Spark finds the offsets small enough to broadcast.
    """
    spans = df.groupBy(*block).agg(F.count("*").alias("_n"), F.min(row).alias("_first"))
    before = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = spans.select(*block, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        df.join(offsets, block)
        .withColumn(out, F.col("_offset") + F.col(row) - F.col("_first"))
        .drop("_first", "_offset")
    )


def with_sequence(df: DataFrame, *order: str, out: str = "pos", partitions: int | None = None) -> DataFrame:
    """Number rows by a unique order.

    A range shuffle sorts the rows; the numbering needs the same partitions twice,
    for counting and for numbering, so the sorted rows are checkpointed in between.
    """
    spark = df.sparkSession
    shared_folder(spark)
    n = partitions or max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(df.count() / ROWS_PER_RANGE))
    placed = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_placed", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_block", F.shiftright("_placed", ROW_BITS))
    )
    return with_positions(placed, ["_block"], "_placed", out).drop("_placed", "_block")
