"""First records, stored statements, and keywords in long texts."""

import random
import time

import pytest
from pyspark.sql import functions as F

from lakecat.functions.domains import with_scored_text
from lakecat.functions.matching import all_words, name_hits, text_hits
from lakecat.functions.rules import SCORED_KEYWORDS
from lakecat.operators.execution import run_stored_queries
from lakecat.session import fresh_path
from lakecat.sources.splits import first_records, read_split


@pytest.fixture(scope="module")
def split(spark):
    """Several files, some empty, of small row groups."""
    path = fresh_path(spark, "split")
    rows = spark.range(5000).select("id", F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"), F.lit(1).alias("pos_of"))
    rows.filter("id < 2400 OR id > 3300").repartitionByRange(6, "id").write.option("parquet.block.size", 4096).parquet(path)
    return path


@pytest.mark.parametrize("n", [0, 1, 50, 901, 2400, 4099, 4100, 100_000])
def test_first_records(spark, split, n):
    got = sorted(map(tuple, first_records(spark, split, n, ["id", "text"]).select("pos", "id", "text").collect()))
    want = sorted(map(tuple, read_split(spark, split).filter(F.col("pos") < n).select("pos", "id", "text").collect()))
    assert got == want and len(got) == min(n, 4099)


def test_first_records_scan_the_first_files_only(spark, split):
    found = first_records(spark, split, 10)
    assert len(found.inputFiles()) == 1 and found.columns == ["id", "text", "pos_of", "pos"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Window" not in plan


def test_first_records_of_nothing(spark):
    path = fresh_path(spark, "empty")
    spark.range(0).write.parquet(path)
    assert first_records(spark, path, 5).count() == 0


def questions(spark, **statements):
    return spark.createDataFrame(list(statements.items()), "id string, sql_query string")


SLOW = "SELECT count(*) AS n FROM range(0, 1000000000000L) WHERE hash(id) = 12345 AND hash(id, 2) = 3"


def test_slow_statements_are_cancelled(spark):
    """The others go on meanwhile, in no need of the slow one's thread."""
    path, started = fresh_path(spark, "results"), time.monotonic()
    fast = {f"q{i}": f"SELECT * FROM range({i})" for i in range(12)}
    results = {r.question_id: r for r in run_stored_queries(questions(spark, slow=SLOW, **fast), path, 3, seconds=6).collect()}
    assert time.monotonic() - started < 60 and len(results) == 13
    assert not results["slow"].execution_success and results["slow"].error_message == "cancelled after 6 s"
    assert 5500 < results["slow"].execution_time_ms < 20_000
    assert all(results[f"q{i}"].result_rows == i for i in range(12))


def test_a_restart_runs_the_rest(spark):
    path = fresh_path(spark, "results")
    first = run_stored_queries(questions(spark, a="SELECT 1", b="SELECT missing"), path)
    stamps = {r.question_id: r.execution_time_ms for r in first.collect()}
    more = questions(spark, a="SELECT 1", b="SELECT 1 AS x", c="SELECT * FROM range(3)")
    second = {r.question_id: r for r in run_stored_queries(more, path).collect()}
    assert second["a"].execution_time_ms == stamps["a"] and not second["b"].execution_success and second["c"].result_rows == 3
    third = run_stored_queries(more, path, again=True)
    assert third.filter("question_id = 'b'").count() == 2 and third.filter("question_id = 'b' AND execution_success").count() == 1
    assert third.count() == 4


WORDS = ["order", "orders", "border", "or", "customer_id", "a.b", "a*", "(x", "é", "ord"]


def test_long_texts_hold_the_same_words_as_names(spark):
    draw = random.Random(2)
    texts = ["", None, "borders ORDERS", "customer_id", "a.b a*(x", "aab axb", "é́", "or" * 50, "bord"]
    texts += ["".join(draw.choice(["or", "der", "s", "b", "o", " ", "rd", "e", "a.", "*"]) for _ in range(40)) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    every = list(dict.fromkeys([*WORDS, *all_words(SCORED_KEYWORDS)]))
    rows = df.select(F.sort_array(name_hits(F.col("t"), every)).alias("one"), F.sort_array(text_hits(F.col("t"), every)).alias("other")).collect()
    assert [r["one"] for r in rows] == [r["other"] or [] for r in rows] and sum(bool(r["one"]) for r in rows) > 250


def test_scores_of_long_texts(spark):
    df = spark.createDataFrame([(1, "Hospital patient, a patient!"), (2, None), (3, "zzz")], "i int, t string")
    assert [tuple(r) for r in with_scored_text(df, "t").orderBy("i").select("domain", "score").collect()] == [
        ("healthcare", 20), ("general", 0), ("general", 0)]
