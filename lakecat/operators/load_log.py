"""The load log: small appended deltas, compacted into one state of bounded size."""

from __future__ import annotations

import json
import time
import uuid
from threading import Lock

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lakecat.schemas import LOAD_LOG, conform, empty_table
from lakecat.sources.copies import opened_store

MOST_DELTAS = 32  # appended before they are compacted
POINTER = "CURRENT"


def kept_entries(log: DataFrame) -> DataFrame:
    """Of every (db_id, table_name) the last entry and the last successful one, which later questions ask for."""
    order = Window.partitionBy("db_id", "table_name", "ok").orderBy(F.desc("load_timestamp"), "target_table_name", "signature")
    last = log.withColumn("_at", F.row_number().over(order)).filter("_at = 1").drop("_at")
    newest = F.max(F.struct("load_timestamp", "ok")).over(Window.partitionBy("db_id", "table_name"))
    return last.withColumn("_newest", newest["ok"]).filter(F.col("ok") | ~F.col("_newest")).drop("_newest")


class LoadLog:
    """A folder of deltas and states, and a pointer to the state in force and the deltas it covers.

    A compaction writes a new state and then renames a new pointer over the old one, so a reader sees the log before or after it.
    What a state covers is removed one compaction later, when readers of the older pointer are done. One process writes a log.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.lock = spark, path.rstrip("/"), Lock()

    def _pointer(self) -> dict:
        where, name = opened_store(f"{self.path}/{POINTER}")
        if where.get_file_info(name).type != fs.FileType.File:
            return {"state": None, "covers": [], "stale": []}
        with where.open_input_file(name) as file:
            return json.loads(file.read())

    def _point(self, pointer: dict) -> None:
        where, name = opened_store(f"{self.path}/{POINTER}")
        draft = f"{name}.{uuid.uuid4().hex}"
        with where.open_output_stream(draft) as out:
            out.write(json.dumps(pointer).encode())
        where.move(draft, name)

    def _deltas(self, pointer: dict) -> list[str]:
        """Names of the deltas that are complete and not covered."""
        where, name = opened_store(self.path)
        found = where.get_file_info(fs.FileSelector(name, allow_not_found=True))
        names = sorted(x.base_name for x in found if x.type == fs.FileType.Directory and x.base_name.startswith("delta-"))
        done = where.get_file_info([f"{name}/{x}/_SUCCESS" for x in names]) if names else []
        whole = {x for x, mark in zip(names, done) if mark.type == fs.FileType.File}
        return sorted(whole - {*pointer["covers"], *pointer["stale"]})

    def add(self, entries: DataFrame) -> None:
        """Append entries; compact if many deltas lie there."""
        with self.lock:
            conform(entries, LOAD_LOG).coalesce(1).write.parquet(f"{self.path}/delta-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}")
            if len(self._deltas(self._pointer())) > MOST_DELTAS:
                self._compact()

    def _read(self, pointer: dict) -> DataFrame:
        names = [*([pointer["state"]] if pointer["state"] else []), *self._deltas(pointer)]
        if not names:
            return empty_table(self.spark, LOAD_LOG)
        return self.spark.read.schema(LOAD_LOG).parquet(*[f"{self.path}/{name}" for name in names])

    def read(self) -> DataFrame:
        """All entries since the last compaction, and those that it kept."""
        return self._read(self._pointer())

    def _compact(self) -> None:
        pointer = self._pointer()
        covered = self._deltas(pointer)
        state = f"state-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        conform(kept_entries(self._read(pointer)), LOAD_LOG).write.parquet(f"{self.path}/{state}")
        old = [pointer["state"]] if pointer["state"] else []
        self._point({"state": state, "covers": covered, "stale": [*pointer["covers"], *old]})
        where, name = opened_store(self.path)
        for gone in pointer["stale"]:  # covered two compactions ago
            if where.get_file_info(f"{name}/{gone}").type == fs.FileType.Directory:
                where.delete_dir(f"{name}/{gone}")

    def compact(self) -> None:
        with self.lock:
            self._compact()
