"""Bulk load of database tables, the load log, and the state it implies."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from itertools import batched
from threading import Lock

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window, functions as F, types as T

from lakecat.functions.naming import clean_file_id, normalised_names, target_table_name, upper_names
from lakecat.functions.text import count_where
from lakecat.functions.typemap import TYPE_MAPS, stored_type
from lakecat.operators.load_log import LoadLog
from lakecat.schemas import METADATA_TABLES, conform, empty_table
from lakecat.session import fresh_path, written
from lakecat.sources.sqlite_source import FAILURES, TARGET, Catalog, scan_ranges, scan_schema, typed

MAX_TABLE_JOBS = 8  # jobs submitted side by side; Spark schedules their tasks


# --- sinks ---

def replace_contents(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Overwrite a table of fixed schema."""
    conform(df, schema).write.mode("overwrite").parquet(path)


def replace_table(df: DataFrame, name: str) -> None:
    """Create or replace a catalog table with the schema of `df`."""
    df.write.mode("overwrite").saveAsTable(name)


def create_metadata_tables(spark: SparkSession, root: str) -> dict[str, str]:
    """Empty metadata tables below `root`; returns their paths."""
    paths = {name: f"{root}/{name}" for name in METADATA_TABLES}
    for name, schema in METADATA_TABLES.items():
        empty_table(spark, schema).write.mode("overwrite").parquet(paths[name])
    return paths


def write_metadata(spark: SparkSession, root: str, filled: dict[str, DataFrame]) -> dict[str, str]:
    """The metadata tables below `root`, those of `filled` with their rows, the others empty; returns their paths."""
    unknown = set(filled) - set(METADATA_TABLES)
    if unknown:
        raise ValueError(f"no metadata tables: {sorted(unknown)}")
    paths = create_metadata_tables(spark, root)
    for name, rows in filled.items():
        replace_contents(rows, paths[name], METADATA_TABLES[name])
    return paths


def read_metadata(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    return {name: spark.read.schema(METADATA_TABLES[name]).parquet(path) for name, path in paths.items()}


# --- load state ---

def latest_state(log: DataFrame) -> DataFrame:
    """The last log entry of each (db_id, table_name)."""
    fields = ["target_table_name", "row_count", "cast_failures", "signature", "ok", "error", "load_timestamp"]
    return log.groupBy("db_id", "table_name").agg(
        F.max_by(F.struct(*fields), F.struct("load_timestamp", "ok")).alias("s")
    ).select("db_id", "table_name", "s.*")


def mark_loaded(table_info: DataFrame, log: DataFrame) -> DataFrame:
    """table_data_info with the tables of successful log entries marked as loaded."""
    done = log.filter(F.col("ok")).groupBy("db_id", "table_name").agg(
        F.max_by("target_table_name", "load_timestamp").alias("new_name"),
        F.max("load_timestamp").alias("new_timestamp"))
    return table_info.join(done, ["db_id", "table_name"], "left").select(
        "db_id", "table_name", "row_count",
        (F.col("data_loaded") | F.col("new_timestamp").isNotNull()).alias("data_loaded"),
        F.coalesce("new_name", "target_table_name").alias("target_table_name"),
        F.coalesce("new_timestamp", "load_timestamp").alias("load_timestamp"),
    )


# --- table choice ---

def first_tables(tables: DataFrame, n: int) -> DataFrame:
    """The first `n` tables in (db_id, table_position) order."""
    return tables.orderBy("db_id", "table_position").limit(n)


def non_empty(tables: DataFrame) -> DataFrame:
    return tables.filter(F.col("row_count") > 0)


# --- load ---

@dataclass
class LoadOptions:
    root: str  # one folder per target table below it
    types: str = "stored"  # what the columns hold; or a map of declared types, see functions.typemap
    prefix: str = "LAKE"
    normalise: bool = True  # blanks and '-' in column names to '_'; False only upper-cases

    def rename(self, names: list[str]) -> list[str]:
        return normalised_names(names) if self.normalise else upper_names(names)


def landing_name(db_id: Column, table_name: Column) -> Column:
    """Folder pair of a copied database table under its cleaned id."""
    return F.concat_ws("/", clean_file_id(db_id), table_name)


def plan_tables(catalog: Catalog, options: LoadOptions) -> DataFrame:
    """(db_id, table_name, table_position, row_count, TARGET, layout, signature, problem).

    `layout` lists (column, declared type, target type) in order: tables that share it
    are read and written by one job. A table is at most as wide as SQLite allows.
    `problem` says why a table cannot be loaded: its rows could not be counted, or a
    table before it in load order has its target name (a_b.c after a.b_c).
    """
    earlier = F.row_number().over(Window.partitionBy(TARGET).orderBy("db_id", "table_position"))
    held = stored_type(F.col("kinds"), F.col("whole"), F.col("scale"))
    target_type = held if options.types == "stored" else TYPE_MAPS[options.types](F.col("column_type"))
    typed_columns = catalog.stored.withColumn("target_type", target_type)
    layouts = typed_columns.groupBy("db_id", "table_name").agg(F.array_sort(F.collect_list(
        F.struct("column_position", "column_name", "column_type", "target_type"))).alias("layout"))
    return catalog.tables.join(layouts, ["db_id", "table_name"]).select(
        "db_id", "table_name", "table_position", "row_count",
        target_table_name(F.col("db_id"), F.col("table_name"), options.prefix).alias(TARGET),
        F.transform("layout", lambda c: F.struct(c.column_name, c.column_type, c.target_type)).alias("layout"),
    ).withColumn("signature", F.sha2(F.to_json("layout"), 256)).withColumn(
        "problem",
        F.when(earlier > 1, "another table has this target name")
        .when(F.col("row_count").isNull(), "rows could not be counted"))


def _write_filled(catalog: Catalog, chosen: DataFrame, layout: list[Row], options: LoadOptions,
                  only: str | None) -> str | None:
    """Write all tables of one layout with one job; the path of their cast failures, if there are any.

    `only` is the target name where there is one table: it needs no partition column,
    and so no sort by it.
    """
    wanted = chosen.select("db_id", "table_name", TARGET)
    ranges = catalog.ranges.filter(F.col("row_count") > 0).join(wanted, ["db_id", "table_name"])
    names, types = [c.column_name for c in layout], [c.target_type for c in layout]
    data = typed(scan_ranges(catalog.files, ranges, names, types), names, types, options.rename)
    seen = Observation()
    rows = data.observe(seen, F.coalesce(F.sum(FAILURES), F.lit(0)).alias("failures")).drop(FAILURES)
    if only:
        rows.drop(TARGET).write.mode("overwrite").parquet(table_path(options.root, only))
    else:
        rows.write.partitionBy(TARGET).mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").parquet(options.root)
    if not seen.get["failures"]:
        return None
    return _lost_values(catalog, wanted, data.drop(FAILURES).schema, options.root)


def _lost_values(catalog: Catalog, wanted: DataFrame, schema: T.StructType, root: str) -> str:
    """The path of a table of (TARGET, cast_failures): values that a database holds and its written table lacks, where there are any.

    A value that does not fit becomes null, so the written files tell, and no database is read again.
    """
    spark = wanted.sparkSession
    paths = [table_path(root, row[TARGET]) for row in wanted.select(TARGET).toLocalIterator()]
    columns = [field.name for field in schema.fields if field.name != TARGET]
    kept = spark.read.schema(schema).option("basePath", root).parquet(*paths).groupBy(TARGET).agg(
        *[F.count(F.col(f"`{name.replace('`', '``')}`")).alias(f"n{i}") for i, name in enumerate(columns)])
    total = kept.select(TARGET, F.aggregate(
        F.array(*[f"n{i}" for i in range(len(columns))]), F.lit(0).cast("bigint"), lambda a, x: a + x).alias("kept"))
    held = catalog.stored.join(wanted, ["db_id", "table_name"]).groupBy(TARGET).agg(F.sum("filled").alias("held"))
    lost = held.join(total, TARGET).select(TARGET, (F.col("held") - F.col("kept")).alias("cast_failures"))
    path = fresh_path(spark, "cast-failures")
    lost.filter("cast_failures > 0").write.parquet(path)
    return path


def _write_empty(spark: SparkSession, layout: list[Row], options: LoadOptions, path: str) -> None:
    names, targets = [c.column_name for c in layout], [c.target_type for c in layout]
    scanned = empty_table(spark, scan_schema(targets))
    shaped = typed(scanned, names, targets, options.rename).drop(TARGET, FAILURES)
    shaped.write.mode("overwrite").parquet(path)


# Characters that Spark escapes in partition folder names.
ESCAPED_IN_FOLDERS = '"#%\'*/:=?\\{[]^\x7f'


def table_path(root: str, target: str) -> str:
    """Folder of a loaded table, spelt as Spark spells a partition folder."""
    spelt = "".join(f"%{ord(c):02X}" if c in ESCAPED_IN_FOLDERS or ord(c) < 32 else c for c in target)
    return f"{root}/{TARGET}={spelt}"


def empty_path(root: str, signature: str) -> str:
    """Folder that all empty tables of one layout share."""
    return f"{root}/_empty/{signature}"


def _location(root: str, state: Row) -> str:
    return empty_path(root, state.signature) if state.row_count == 0 else table_path(root, state.target_table_name)


def read_table(spark: SparkSession, root: str, log: DataFrame, target: str) -> DataFrame:
    """A loaded table by its target name."""
    state = latest_state(log).filter(F.col("ok") & (F.col("target_table_name") == target)).first()
    if state is None:
        raise ValueError(f"table {target} is not loaded")
    return spark.read.parquet(_location(root, state))


def publish_tables(spark: SparkSession, root: str, log: DataFrame) -> int:
    """A temporary view per loaded table, under its target name; returns their number."""
    n = 0
    for state in latest_state(log).filter("ok").toLocalIterator():
        name = state.target_table_name.replace("`", "``")
        spark.read.parquet(_location(root, state)).createOrReplaceTempView(f"`{name}`")
        n += 1
    return n


def _entries(chosen: DataFrame, error: str | Column | None = None) -> DataFrame:
    """Log entries of planned tables; `chosen` may bring cast_failures."""
    failures = F.coalesce("cast_failures", F.lit(0)) if "cast_failures" in chosen.columns else F.lit(0)
    message = error if isinstance(error, Column) else F.lit(error).cast("string")
    return chosen.select(
        "db_id", "table_name", F.col(TARGET).alias("target_table_name"), "row_count", failures.cast("bigint").alias("cast_failures"),
        "signature", message.isNull().alias("ok"), message.alias("error"),
        F.current_timestamp().alias("load_timestamp"))


@dataclass
class _Half:
    """The tables of a layout whose target's hash ends in `bits`, `depth` of them: a failed job is halved by one more bit."""

    depth: int = 0
    bits: int = 0

    @property
    def mask(self) -> int:
        return (1 << self.depth) - 1

    def holds(self, planned: DataFrame) -> DataFrame:
        return planned.filter(F.xxhash64(TARGET).bitwiseAND(F.lit(self.mask).cast("bigint")) == self.bits)

    def halves(self) -> list[_Half]:
        return [_Half(self.depth + 1, self.bits | bit << self.depth) for bit in (0, 1)]


@dataclass
class _Batch:
    """What has become of the layouts since the last log entries; jobs report from several threads."""

    outcomes: list[tuple[str, bool, int, int, str | None]] = field(default_factory=list)
    failures: list[str] = field(default_factory=list)  # paths
    lock: Lock = field(default_factory=Lock)

    def report(self, signature: str, filled: bool, half: _Half, error: str | None, failures: str | None = None) -> None:
        with self.lock:
            self.outcomes.append((signature, filled, half.mask, half.bits, error))
            if failures is not None:
                self.failures.append(failures)

    def flush(self, planned: DataFrame, log: LoadLog) -> None:
        """One append for all outcomes."""
        with self.lock:
            outcomes, self.outcomes = self.outcomes, []
            failures, self.failures = self.failures, []
        if not outcomes:
            return
        spark = planned.sparkSession
        known = spark.createDataFrame(outcomes, "signature string, filled boolean, mask long, bits long, _error string")
        entries = planned.withColumn("filled", F.col("row_count") > 0).join(known, ["signature", "filled"]).filter(
            F.xxhash64(TARGET).bitwiseAND(F.col("mask")) == F.col("bits"))
        if failures:
            lost = spark.read.schema(f"{TARGET} string, cast_failures bigint").parquet(*failures)
            entries = entries.join(lost, TARGET, "left")
        log.add(_entries(entries, F.col("_error")))


FLUSHED_LAYOUTS = 64  # outcomes kept before they are logged


def _load_filled(catalog: Catalog, chosen: DataFrame, group: Row, options: LoadOptions, batch: _Batch) -> None:
    """The tables with rows of one layout. If a job fails, its tables are halved, until those at fault are alone."""
    left = [_Half()]
    while left:
        half = left.pop()
        own = half.holds(chosen)
        some = [row[TARGET] for row in own.select(TARGET).limit(2).collect()]
        if not some:
            continue
        try:
            failures = _write_filled(catalog, own, group.layout, options, some[0] if len(some) == 1 else None)
            batch.report(group.signature, True, half, None, failures)
        except Exception as error:
            if len(some) == 1 or half.depth == 63:
                batch.report(group.signature, True, half, str(error))
            else:
                left += half.halves()


def _load_layout(catalog: Catalog, planned: DataFrame, group: Row, options: LoadOptions, batch: _Batch) -> None:
    spark = planned.sparkSession
    # Where the scheduler is fair, layouts share the executors instead of waiting for the first one.
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"load-{group.signature[:8]}")
    chosen = planned.filter(F.col("signature") == group.signature)
    if group.n_filled:
        _load_filled(catalog, non_empty(chosen), group, options, batch)
    if group.n_empty:
        try:
            _write_empty(spark, group.layout, options, empty_path(options.root, group.signature))
            batch.report(group.signature, False, _Half(), None)
        except Exception as error:
            batch.report(group.signature, False, _Half(), str(error))


def _load_all(catalog: Catalog, planned: DataFrame, options: LoadOptions, log: LoadLog) -> int:
    """Load every layout of `planned`; returns their number."""
    has_rows = F.col("row_count") > 0
    layouts = planned.groupBy("signature").agg(
        F.first("layout").alias("layout"),
        F.count_if(has_rows).alias("n_filled"), F.count_if(~has_rows).alias("n_empty"))
    batch, number = _Batch(), 0
    with ThreadPoolExecutor(MAX_TABLE_JOBS) as pool:
        for groups in batched(layouts.toLocalIterator(), FLUSHED_LAYOUTS):
            for job in [pool.submit(_load_layout, catalog, planned, group, options, batch) for group in groups]:
                job.result()
                number += 1
            batch.flush(planned, log)
    return number


def load_tables(catalog: Catalog, options: LoadOptions, log_path: str, max_tables: int | None = None) -> DataFrame:
    """Copy tables to Parquet below `options.root`; returns the load log.

    Tables of one layout go in one job, layouts side by side. A table that fails is a
    log entry, not an abort. With `max_tables`, the first tables in catalog order are
    taken until that many have succeeded, with those the log already holds: a failure
    makes room for the next table.
    """
    log = LoadLog(catalog.tables.sparkSession, log_path)
    planned = written(plan_tables(catalog, options), "planned")
    if planned.filter(F.col("problem").isNotNull()).limit(1).count():
        log.add(_entries(planned.filter(F.col("problem").isNotNull()), F.col("problem")))
    loadable = planned.filter(F.col("problem").isNull())
    if max_tables is None:
        _load_all(catalog, loadable, options, log)
        return log.read()
    while (missing := max_tables - log.read().filter(F.col("ok")).select("db_id", "table_name").distinct().count()) > 0:
        ahead = loadable.join(log.read().select("db_id", "table_name"), ["db_id", "table_name"], "left_anti")
        if not _load_all(catalog, written(first_tables(ahead, missing), "batch"), options, log):
            break
    return log.read()


def loaded_counts(log: DataFrame) -> DataFrame:
    """(db_id, tables_loaded, rows_loaded) by the latest state."""
    return latest_state(log).groupBy("db_id").agg(
        count_where(F.col("ok")).alias("tables_loaded"),
        F.sum(F.when(F.col("ok"), F.col("row_count"))).alias("rows_loaded"))
