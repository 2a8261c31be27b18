"""Run stored SQL statements and record time, rows, success and error."""

from __future__ import annotations

import re
import time
import uuid
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from threading import Event, Timer, current_thread

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from lakecat.schemas import EXECUTION_RESULTS, conform, empty_table

RESULT_BATCH, RESULT_SECONDS = 200, 60  # results kept on the driver, and for how long, before they are appended


# What a query begins with, after comments and opening brackets.
_QUERY = re.compile(r"(?:\s|\(|--[^\n]*\n|/\*.*?\*/)*(?:SELECT|WITH|FROM|VALUES|TABLE)\b", re.IGNORECASE | re.DOTALL)


def query_only(spark: SparkSession, statement: str) -> DataFrame:
    """The rows of a query. The statement is parsed alone, by EXPLAIN, before it runs; commands are refused.

    The analysed plan of a statement without result columns, such as an insert behind WITH, has an empty schema line.
    """
    if not _QUERY.match(statement):
        raise ValueError("not a query")
    plan = spark.sql(f"EXPLAIN EXTENDED {statement}").first()[0]
    analysed = plan.partition("== Analyzed Logical Plan ==\n")[2].split("\n", 1)
    if len(analysed) < 2 or not analysed[0].strip():
        raise ValueError(plan if "Exception" in plan else "not a query")
    return spark.sql(statement)


def _run(spark: SparkSession, question_id: str, statement: str, seconds: float | None) -> dict:
    """Execute one statement under a job group of its own, whose jobs end at the time limit."""
    started, late = time.perf_counter(), Event()
    rows, error = None, None
    group = f"stored-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, f"stored query {question_id}", interruptOnCancel=True)
    # A pool for each thread: with a fair scheduler a slow statement leaves the others their share of the executors.
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", current_thread().name.replace("ThreadPoolExecutor", "stored"))

    def cancel() -> None:
        """Again and again, as a statement may be between two jobs."""
        late.set()
        while not ended.wait(0.5):
            spark.sparkContext.cancelJobGroup(group)

    ended = Event()
    timer = Timer(seconds, cancel) if seconds else None
    if timer:
        timer.daemon = True
        timer.start()
    try:
        rows = _rows_produced(query_only(spark, statement))
    except Exception as failure:
        error = f"cancelled after {seconds:g} s" if late.is_set() else str(failure)
    finally:
        ended.set()
        if timer:
            timer.cancel()
    return {
        "question_id": question_id,
        "execution_time_ms": (time.perf_counter() - started) * 1000.0,
        "result_rows": rows,
        "execution_success": error is None,
        "error_message": error,
    }


def _rows_produced(result: DataFrame) -> int:
    """Number of rows of a full execution: every column is computed, none is kept."""
    seen = Observation()
    named = result.toDF(*[f"c{i}" for i in range(len(result.columns))])
    named.observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    return seen.get["n"]


class _Results:
    """Results on their way to a table: appended when there are many, or when the first of them is old."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.held, self.since = spark, path, [], time.monotonic()

    def add(self, done: set[Future]) -> None:
        if not self.held:
            self.since = time.monotonic()
        self.held += [job.result() for job in done]
        if len(self.held) >= RESULT_BATCH or time.monotonic() - self.since >= RESULT_SECONDS:
            self.append()

    def append(self) -> None:
        if self.held:
            columns = "question_id string, execution_time_ms double, result_rows bigint, execution_success boolean," \
                      " error_message string"
            rows = conform(self.spark.createDataFrame(self.held, columns), EXECUTION_RESULTS)
            rows.coalesce(1).write.mode("append").parquet(self.path)
            self.held = []


def run_stored_queries(questions: DataFrame, path: str, parallel: int = 4, seconds: float | None = None,
                       again: bool = False) -> DataFrame:
    """Execute `sql_query` of each question against the session's tables; all results below `path`.

    Each statement is a Spark job of its own and fails on its own; with `seconds`, one that takes longer is cancelled and logged
    as failed. `parallel` statements run at any time: a slow one holds up no other. Results are appended to `path` as they
    come, a bounded number at a time, and questions that have a result there are not run again, so a run that broke off
    goes on where it was; with `again`, those that failed are run once more.
    """
    spark = questions.sparkSession
    conform(empty_table(spark, EXECUTION_RESULTS), EXECUTION_RESULTS).write.mode("append").parquet(path)
    known = spark.read.schema(EXECUTION_RESULTS).parquet(path)
    done = known.filter("execution_success") if again else known
    left = questions.join(done.select(F.col("question_id").alias("id")), "id", "left_anti").select("id", "sql_query")
    results, running = _Results(spark, path), set()
    with ThreadPoolExecutor(parallel) as pool:
        for row in left.toLocalIterator():
            running.add(pool.submit(_run, spark, row.id, row.sql_query, seconds))
            if len(running) >= 2 * parallel:  # so many wait that none of the threads does
                ended, running = wait(running, return_when=FIRST_COMPLETED)
                results.add(ended)
        while running:
            ended, running = wait(running, return_when=FIRST_COMPLETED)
            results.add(ended)
    results.append()
    return spark.read.schema(EXECUTION_RESULTS).parquet(path)
