"""A training corpus from raw documents: toxic ones out, one of each near-duplicate group, mixed by source, encoded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakecat.llm import jaccard, mixing, pieces, toxicity
from lakecat.llm.common import ship, small
from lakecat.llm.queries import PIECES, table, tokenizer_file
from lakecat.session import written

#: The score from which on a document is rejected.
REJECTED = 0.3
#: Near-duplicates: shingles of five words, similarity of 0.8 or more.
WORDS, PERCENT = 5, 80


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that score below `REJECTED`, by a model of the labelled ones; all columns as they were."""
    ship(spark)
    scored = toxicity.score_documents(docs, table(spark, sf_dir, "labels"))
    return scored.filter(F.col("toxicity") < REJECTED).select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones, that with the smallest doc_id; texts without words all stay.

    What goes is a list of hashes of id and text, so texts are not shuffled while the list is small.
    """
    ship(spark)
    members = jaccard.jaccard_components(docs, WORDS, PERCENT).filter("component IS NOT NULL")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "doc_hash")
    chosen = members.groupBy("component").agg(F.min(first)["doc_hash"].alias("doc_hash"))
    gone = written(members.join(chosen, ["component", "doc_hash"], "left_anti").select("doc_hash").distinct(), "near-duplicates")
    mark = "_near_duplicate_hash"
    marked = docs.withColumn(mark, F.xxhash64("doc_id", "text"))
    kept = marked.join(small(gone.withColumnRenamed("doc_hash", mark)), mark, "left_anti")
    if members.groupBy("doc_hash").count().filter("count > 1").limit(1).count():  # rows that repeat id and text
        with_words = F.col("text").rlike(r"[^\x20\x09-\x0D]")
        kept = kept.filter(with_words).dropDuplicates([mark]).unionByName(kept.filter(~F.coalesce(with_words, F.lit(False))))
    return kept.select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents repeated to their sources' targets, one row a repetition; documents without words go."""
    return mixing.repeated(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every repetition: doc_id, n_pieces, ids, cost."""
    ship(spark)
    return pieces.encode(docs, tokenizer_file(PIECES), with_text=False).select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "cost")


STAGES = [
    ("toxicity", without_toxic),
    ("jaccard", without_near_duplicates),
    ("mixing", mixed),
    ("pieces", encoded),
]

#: Toxicity and encoding are no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
