"""Many small databases: what is done per task, and how often."""

import sqlite3
from contextlib import closing

import pytest
from databases import make_database
from pyspark.sql import functions as F

from lakecat.sources import files as lf, sqlite_source
from lakecat.sources.payloads import land_databases
from lakecat.sources.sqlite_source import TARGET, decimal_places, profile_databases, scan_ranges


@pytest.fixture(scope="module")
def profile(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("many")
    for i in range(40):
        make_database(folder / f"d{i}.sqlite", "CREATE TABLE t (a INTEGER, m NUMERIC)", rows=[
            ("INSERT INTO t VALUES (?, ?)", [(i, 2 ** 53 + 1 + 2 * i), (i, 0.25)])])
    return profile_databases(lf.discover_flat(spark, str(folder)))


def test_small_ranges_share_tasks(spark, profile):
    ranges = profile.ranges.withColumn(TARGET, F.col("db_id"))
    scanned = scan_ranges(profile.files, ranges, ["a"], ["INTEGER"])
    assert scanned.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism < 40
    assert sorted((r[TARGET], r.v0) for r in scanned.collect()) == sorted((f"d{i}", i) for i in range(40) for _ in range(2))


def test_large_ranges_keep_tasks_of_their_own(spark, profile, monkeypatch):
    monkeypatch.setattr(sqlite_source, "TASK_ROWS", 2)
    assert sqlite_source.scan_tasks(profile.ranges) == 40
    assert sqlite_source.scan_tasks(profile.ranges.drop("row_count")) == 40
    assert sqlite_source.scan_tasks(profile.ranges.limit(0)) == 1


def test_decimal_places_are_found_by_many_tasks(spark, profile):
    places = decimal_places(profile.files, profile.ranges, profile.stored.drop("whole", "scale"))
    plan = places._jdf.queryExecution().executedPlan().toString()
    assert f"RoundRobinPartitioning({4 * spark.sparkContext.defaultParallelism})" in plan
    assert {(r.column_name, r.whole, r.scale) for r in places.collect()} == {("m", 16, 2)}


def test_landed_payloads_are_made_once(spark, tmp_path):
    """Each making of a payload leaves a mark. Ids that clean to one name are two files, and no draft is left."""
    with closing(sqlite3.connect(":memory:")) as db:
        db.execute("CREATE TABLE t (v)")
        db.commit()
        payload = db.serialize()
    marks = str(tmp_path / "marks")

    def made(batches):
        import os
        import uuid

        import pyarrow as pa

        for batch in batches:
            ids = batch.column("db_id").to_pylist()
            for _ in ids:
                os.makedirs(marks, exist_ok=True)
                open(os.path.join(marks, uuid.uuid4().hex), "w").close()
            yield pa.RecordBatch.from_pydict({"db_id": ids, "length": [len(payload)] * len(ids), "payload": [payload] * len(ids)})

    ids = spark.createDataFrame([("a",), ("a!",), ("b",), ("ü c",)], "db_id string")
    landed = land_databases(ids.mapInArrow(made, "db_id string, length bigint, payload binary"), str(tmp_path / "landed")).collect()
    assert len(list((tmp_path / "marks").iterdir())) == 4
    assert {r.db_id for r in landed} == {"a", "a!", "b", "ü c"} and len({r.path for r in landed}) == 4
    files = [path for path in (tmp_path / "landed").rglob("*") if path.is_file()]
    assert {str(path) for path in files} == {r.path for r in landed} and all(path.read_bytes() == payload for path in files)
    assert {path.name for path in files} > {"b.sqlite", "üc.sqlite"}
