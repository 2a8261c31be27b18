"""The load log, casts that fail, and jobs that fail."""

import json

import pytest
from databases import make_database
from pyspark.sql import functions as F

from lakecat.operators import load
from lakecat.operators.load import LoadOptions, latest_state, load_tables, mark_loaded, read_table
from lakecat.operators.load_log import MOST_DELTAS, LoadLog, kept_entries
from lakecat.session import fresh_path
from lakecat.sources import files as lf
from lakecat.sources.copies import opened_store
from lakecat.sources.sqlite_source import profile_databases

FIELDS = ("db_id string, table_name string, target_table_name string, row_count bigint, cast_failures bigint, signature string,"
          " ok boolean, error string, load_timestamp timestamp")


def entries(spark, first, n, ok=True, second=0):
    return spark.range(first, first + n).select(
        F.concat(F.lit("d"), F.col("id") % 40).alias("db_id"), F.concat(F.lit("t"), F.col("id") % 1000).alias("table_name"),
        F.concat(F.lit("T"), F.col("id")).alias("target_table_name"), F.col("id").alias("row_count"), F.lit(0).alias("cast_failures"),
        F.lit("s").alias("signature"), F.lit(ok).alias("ok"), F.lit(None if ok else "no").alias("error"),
        F.timestamp_seconds(F.lit(1_700_000_000 + second) + F.col("id")).alias("load_timestamp"))


def rows_of(df):
    return {tuple(row) for row in df.collect()}


def test_ten_thousand_entries_keep_a_bounded_number_of_files(spark):
    path = fresh_path(spark, "log")
    log, everything = LoadLog(spark, path), None
    for i in range(50):
        part = entries(spark, 200 * i, 200, ok=i % 3 != 0)
        log.add(part)
        everything = part if everything is None else everything.union(part)
    where, name = opened_store(path)
    from pyarrow import fs

    files = [x for x in where.get_file_info(fs.FileSelector(name, recursive=True)) if x.path.endswith(".parquet")]
    assert len(files) < 4 * MOST_DELTAS + 8
    known = everything.cache()
    assert known.count() == 10_000 and log.read().count() < 2 * 2000 + 200 * (MOST_DELTAS + 1)
    assert rows_of(latest_state(log.read())) == rows_of(latest_state(known))
    info = known.select("db_id", "table_name").distinct().select(
        "*", F.lit(1).alias("row_count"), F.lit(False).alias("data_loaded"), F.lit("x").alias("target_table_name"),
        F.lit(None).cast("timestamp").alias("load_timestamp"))
    assert rows_of(mark_loaded(info, log.read())) == rows_of(mark_loaded(info, known))
    before = rows_of(latest_state(log.read()))
    log.compact()
    assert rows_of(latest_state(log.read())) == before
    known.unpersist()


def test_a_failure_after_a_success_keeps_both(spark):
    log = entries(spark, 0, 3).union(entries(spark, 0, 2, ok=False, second=50)).union(entries(spark, 0, 1, second=90))
    kept = kept_entries(log)
    assert sorted((r.table_name, r.ok) for r in kept.collect()) == [("t0", True), ("t1", False), ("t1", True), ("t2", True)]
    assert rows_of(latest_state(kept)) == rows_of(latest_state(log))


def test_an_interrupted_compaction_changes_nothing(spark):
    """A state without its pointer, and a delta without its mark, are not read."""
    path = fresh_path(spark, "log")
    log = LoadLog(spark, path)
    log.add(entries(spark, 0, 5))
    entries(spark, 100, 5).select("*").write.parquet(f"{path}/state-lost")
    where, name = opened_store(path)
    where.create_dir(f"{name}/delta-00000000000000000001-broken")
    assert log.read().count() == 5 and LoadLog(spark, path).read().count() == 5
    log.compact()
    log.add(entries(spark, 10, 5))
    pointer = json.loads(where.open_input_file(f"{name}/CURRENT").read())
    assert pointer["state"] != "state-lost" and log.read().count() == 10
    assert LoadLog(spark, fresh_path(spark, "log")).read().count() == 0


@pytest.fixture
def many(tmp_path):
    """Databases of one layout, in which some values do not fit their declared types."""
    for i in range(9):
        bad = i % 4
        make_database(tmp_path / f"m{i}.sqlite", "CREATE TABLE t (day DATE, amount DECIMAL(15,2), n INTEGER)", rows=[
            ("INSERT INTO t VALUES (?, ?, ?)",
             [("2024-01-02", 1.5, 3)] * 5 + [("never", 2.5, None)] * bad + [("2024-02-30", 3.5, "many")] * (bad // 2))])
    return tmp_path


def test_failing_casts_are_counted_per_table_without_a_second_read(spark, many, monkeypatch):
    scans = []
    scan = load.scan_ranges
    monkeypatch.setattr(load, "scan_ranges", lambda *args: scans.append(1) or scan(*args))
    options = LoadOptions(fresh_path(spark, "loaded"), types="sized")
    log = load_tables(profile_databases(lf.discover_flat(spark, str(many))), options, fresh_path(spark, "log"))
    assert len(scans) == 1
    assert {(r.db_id, r.cast_failures) for r in latest_state(log).collect()} == {
        (f"m{i}", i % 4 + 2 * (i % 4 // 2)) for i in range(9)}
    assert read_table(spark, options.root, log, "LAKE_M3_T").filter("DAY IS NULL").count() == 4


def test_failed_jobs_are_halved(spark, many, monkeypatch):
    """Two damaged tables among nine: the others load, in fewer jobs than tables times two, and the log gets one append."""
    write, jobs, appends = load._write_filled, [], []

    def failing(catalog, chosen, layout, options, only):
        held = {r.db_id for r in chosen.select("db_id").collect()}
        jobs.append(held)
        if held & {"m2", "m7"}:
            raise ValueError(f"broken: {sorted(held)}")
        return write(catalog, chosen, layout, options, only)

    monkeypatch.setattr(load, "_write_filled", failing)
    add = LoadLog.add
    monkeypatch.setattr(LoadLog, "add", lambda self, rows: appends.append(1) or add(self, rows))
    options = LoadOptions(fresh_path(spark, "loaded"), types="sized")
    log = load_tables(profile_databases(lf.discover_flat(spark, str(many))), options, fresh_path(spark, "log"))
    state = {r.db_id: (r.ok, r.error) for r in latest_state(log).collect()}
    assert {db_id for db_id, (ok, _) in state.items() if not ok} == {"m2", "m7"} and len(state) == 9
    assert state["m2"][1] == "broken: ['m2']" and len(jobs) < 18 and appends == [1]
    assert read_table(spark, options.root, log, "LAKE_M3_T").count() == 5 + 3 + 1
