"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakecat.session import written


def components(links: DataFrame) -> DataFrame:
    """Every linked vertex (v) with the smallest vertex of its component (label).

    Each round takes the smallest label among a vertex and its neighbours, then the label of
    that label, so that distances halve; the driver sees only whether anything changed.
    `links` has the columns a and b. Every round is written, which cuts the lineage.
    """
    ends = links.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL")
    around = ends.union(ends.select("b", "a"))
    near = written(around.union(around.select("a", F.col("a").alias("b"))).distinct(), "links")
    labels = written(near.groupBy("a").agg(F.min("b").alias("label")).withColumnRenamed("a", "v"), "labels")
    while True:
        met = near.join(labels.withColumnRenamed("v", "b"), "b").groupBy("a").agg(F.min("label").alias("label"))
        of_label = met.select(F.col("a").alias("label"), F.col("label").alias("further"))
        jumped = met.join(of_label, "label").select(F.col("a").alias("v"), F.col("further").alias("label"))
        old = labels.withColumnRenamed("label", "old")
        fresh = written(jumped.join(old, "v").select("v", "label", (F.col("label") != F.col("old")).alias("moved")), "labels")
        labels = fresh.select("v", "label")
        if not fresh.filter("moved").limit(1).count():
            return labels
