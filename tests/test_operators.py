"""Ids, questions, load state, checks, report and execution."""

import json

import pytest
from databases import make_database
from pyspark.sql import functions as F

from lakecat import schemas
from lakecat.functions import rules
from lakecat.operators import catalog, checks, execution, load, questions, report
from lakecat.operators.sequence import with_sequence
from lakecat.session import fresh_path, shared_folder
from lakecat.sources import files, payloads, splits
from lakecat.sources.sqlite_source import profile_databases


def rows_of(df):
    return sorted(tuple(row) for row in df.collect())


def test_sequence_is_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000 * 3).alias("key"))
    numbered = with_sequence(df, "key", partitions=7)
    assert rows_of(numbered.select("pos", "key")) == [(i, i * 3) for i in range(1000)]


def test_parquet_split_positions_follow_the_files(spark, tmp_path):
    for part in range(3):
        spark.range(part * 10, part * 10 + 10).coalesce(1).write.mode("append").parquet(str(tmp_path / f"s/p{part}"))
    read = splits.read_split(spark, str(tmp_path / "s" / "*"))
    assert rows_of(read.select("pos", "id")) == [(i, i) for i in range(30)]


def test_json_split_positions_follow_the_lines(spark, tmp_path):
    lines = [json.dumps({"db_id": f"d{i}", "question": "é" * (i % 50), "SQL": "SELECT 1"}) for i in range(3000)]
    (tmp_path / "split.jsonl").write_text("\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        read = splits.read_split(spark, str(tmp_path), "db_id string, question string, SQL string", "json")
        assert rows_of(read.select("pos", "db_id")) == [(i, f"d{i}") for i in range(3000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_dev_questions_keep_nulls_and_fill_missing_fields(spark):
    records = spark.createDataFrame(
        [(0, "retail_shop", None), (1, None, "SELECT 1")], "pos long, db_id string, SQL string")
    found = questions.normalise_questions(records).orderBy("id").collect()
    assert [tuple(row) for row in found] == [
        ("lake_000000", "retail_shop", "", "", None, "unknown", "retail", "q_0"),
        ("lake_000001", None, "", "", "SELECT 1", "unknown", "general", "q_1")]


def test_flash_questions_take_the_first_field_that_exists(spark):
    both = spark.createDataFrame([(0, "x", None, "b")], "pos long, query string, clean_up_sql string, preprocess_sql string")
    assert questions.questions_from({"flash": both}).first().sql_query is None
    one = both.drop("clean_up_sql")
    assert questions.questions_from({"flash": one}).first().sql_query == "b"
    assert questions.questions_from({"flash": one.drop("preprocess_sql")}).first().sql_query == ""


def test_slice_limits_compose(spark):
    records = spark.range(200).withColumnRenamed("id", "pos")
    assert questions.positional_slice(records, 100, limit=50).count() == 50
    assert questions.positional_slice(records, 10, limit=50).count() == 10


def test_first_seen_databases(spark):
    df = spark.createDataFrame([("b", 3), ("a", 2), ("b", 1), ("", 0), (None, 4)], "db_id string, pos long")
    assert rows_of(questions.databases_of(df).select("db_id", "first_pos")) == [("a", 2), ("b", 1)]


def test_last_foreign_key_marks_the_column(spark):
    columns = spark.createDataFrame([("d", "t", "c", "INTEGER", False, 0), ("d", "t", "C", "TEXT", False, 1)],
                                    "db_id string, table_name string, column_name string, column_type string,"
                                    " is_primary_key boolean, column_position int")
    fks = spark.createDataFrame([("d", "t", "c", "x", "i", 0), ("d", "t", "c", "y", None, 1), ("d", "t", "gone", "z", "i", 2)],
                                "db_id string, source_table string, source_column string, target_table string,"
                                " target_column string, seq int")
    marked = catalog.table_schemas(columns, fks)
    assert [tuple(r) for r in marked.orderBy("column_position").select(
        "column_name", "is_foreign_key", "foreign_table", "foreign_column").collect()] == [
        ("c", True, "y", None), ("C", False, None, None)]


def test_complexity_of_nothing(spark):
    empty = spark.createDataFrame([], "db_id string, complexity_score double")
    assert tuple(catalog.complexity_range(empty).first()) == (0.0, 0.0, 0.0, None, None)


def test_load_state_is_idempotent(spark):
    info = spark.createDataFrame(
        [("d", "t", 5, False, "LAKE_D_T", None), ("d", "u", 1, False, "LAKE_D_U", None)],
        "db_id string, table_name string, row_count long, data_loaded boolean, target_table_name string,"
        " load_timestamp timestamp")
    log = spark.sql(
        "SELECT 'd' db_id, 't' table_name, 'NEW' target_table_name, 5L row_count, 0L cast_failures, 's' signature,"
        " true ok, CAST(NULL AS STRING) error, TIMESTAMP'2024-01-01' load_timestamp"
        " UNION ALL SELECT 'd', 'u', 'LAKE_D_U', 1L, 0L, 's', false, 'broken', TIMESTAMP'2024-01-01'")
    once = load.mark_loaded(info, log)
    assert rows_of(once.select("table_name", "data_loaded", "target_table_name")) == [
        ("t", True, "NEW"), ("u", False, "LAKE_D_U")]
    assert load.mark_loaded(once, log).exceptAll(once).count() == 0


def test_metadata_tables_keep_their_schema(spark):
    paths = load.create_metadata_tables(spark, fresh_path(spark, "metadata"))
    for name, path in paths.items():
        stored = spark.read.parquet(path)
        assert stored.count() == 0 and stored.columns == schemas.METADATA_TABLES[name].fieldNames()


def test_replace_contents_and_table(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (3, 2):
        load.replace_contents(spark.range(n).selectExpr("id AS question_id"), path, schemas.EXECUTION_RESULTS)
    stored = spark.read.parquet(path)
    assert stored.count() == 2 and stored.filter("created_at IS NULL").count() == 0


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "id string")
    assert set(map(tuple, checks.duplicate_keys(df, ["id"]).collect())) == {("a", 2), (None, 1)}
    assert tuple(checks.key_check(df, ["id"]).first()) == (2, 1, 1)


def test_load_checks_flag_missing_data(spark):
    info = spark.createDataFrame([("d", "t", True), ("d", "u", False)], "db_id string, table_name string, data_loaded boolean")
    found = {r.check: (r.value, r.ok) for r in checks.load_checks(table_info=info).collect()}
    assert found == {"tables_with_data": (1, True), "tables_without_data": (1, False)}


def test_a_check_that_cannot_run_is_a_row(spark, tmp_path):
    spark.range(3).selectExpr("'q' AS db_id", "'SELECT 1' AS sql_query").write.parquet(str(tmp_path / "gone"))
    broken = spark.read.parquet(str(tmp_path / "gone"))
    for file in (tmp_path / "gone").glob("*.parquet"):
        file.write_bytes(b"not parquet")
    info = spark.createDataFrame([("d", "t", True)], "db_id string, table_name string, data_loaded boolean")
    found = checks.run_load_checks(spark, questions=broken, table_info=info).collect()
    assert [(r.table, r.ok) for r in found] == [
        ("questions", False), ("table_data_info", True), ("table_data_info", True)]
    assert found[0].error and found[1].error is None


def test_report_is_written_with_nulls(spark, tmp_path):
    databases = spark.createDataFrame(
        [("a", 1, 2, 0, 5, 1.2, "retail"), ("b", 3, 4, 1, 7, 5.4, "general")],
        "db_id string, table_count long, total_columns long, total_foreign_keys long, total_rows long,"
        " complexity_score double, domain string")
    tables = spark.createDataFrame([("b", "y"), ("b", "x")], "db_id string, table_name string")
    report.write_report(databases, tables, str(tmp_path))
    listed = {r.db_id: r.tables for r in spark.read.json(str(tmp_path / "database_list")).collect()}
    assert listed == {"a": [], "b": ["x", "y"]}
    one = spark.read.json(str(tmp_path / "complexity_analysis")).first()
    assert (one.most_complex, one.least_complex, one.max_complexity) == ("b", "a", 5.4)


def test_stored_queries_cannot_change_the_session(spark):
    spark.range(3).createOrReplaceTempView("kept")
    statements = [("a", "SELECT * FROM kept"), ("b", "DROP VIEW kept"), ("c", "SELECT 1) ; DROP VIEW kept; SELECT (1"),
                  ("d", "INSERT INTO kept VALUES (1)"), ("e", "SELECT id FROM kept ORDER BY id LIMIT 2;")]
    asked = spark.createDataFrame(statements, "id string, sql_query string")
    results = execution.run_stored_queries(asked, fresh_path(spark, "results"))
    assert results.columns == schemas.EXECUTION_RESULTS.fieldNames()
    assert rows_of(results.select("question_id", F.coalesce("result_rows", F.lit(-1)), "execution_success")) == [
        ("a", 3, True), ("b", -1, False), ("c", -1, False), ("d", -1, False), ("e", 2, True)]
    assert spark.table("kept").count() == 3
    assert results.filter("execution_time_ms IS NULL OR (error_message IS NULL) != execution_success").count() == 0


def test_discovery(spark, tmp_path):
    header = b"SQLite format 3\x00"
    for path, content in {
        "a.sqlite": header, "b.DB": header, "c.txt": header, "big": header + b"\0" * 2000, "small": header,
        "other": b"x" * 2000, "my_database/deep/d.sqlite": header, "x/a.sqlite": header,
    }.items():
        target = tmp_path / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(content)
    found = files.discover_recursive(spark, str(tmp_path))
    listed = {row.db_id: row.path.split(tmp_path.name, 1)[1] for row in found.collect()}
    assert listed == {
        "a": "/a.sqlite", "b": "/b.DB", "big": "/big", "d": "/my_database/deep/d.sqlite",
        "my_database_d": "/my_database/deep/d.sqlite"}
    assert rows_of(files.discover_flat(spark, str(tmp_path)).select("db_id")) == [("a",)]
    named = files.suffixed(files.list_files(spark, str(tmp_path), "*", recursive=True))
    assert [row.path.endswith("/x/a.sqlite") for row in files.shadowed_files(named).collect()] == [True]


def test_payload_kinds(spark):
    records = spark.createDataFrame([
        ("a", "U1FMaXRl"), ("b", "http://host/file.sqlite"), ("c", "not base64!"), ("d", None), ("e", ""), ("", "U1FM"),
    ], "db_id string, db_file string")
    assert rows_of(payloads.decode_payloads(records).select("db_id", "kind")) == [
        ("a", "base64"), ("b", "url"), ("c", "unknown")]
    binary = records.select("db_id", F.lit(b"SQLite format 3 ...").alias("database"), "db_file")
    decoded = payloads.decode_payloads(binary)
    assert {row.kind for row in decoded.collect()} == {"bytes"}
    assert payloads.databases_in(decoded).count() == 5
    assert payloads.decode_payloads(records.select("db_id")).count() == 0


def test_first_source_with_databases_wins(spark, lake, tmp_path):
    """Neither files without tables nor files that only begin like a database make a source."""
    make_database(tmp_path / "none.sqlite", "PRAGMA user_version = 1")
    (tmp_path / "odd.sqlite").write_bytes(b"SQLite format 3\x00" + b"\x01" * 3000)
    invalid, empty = files.discover_flat(spark, str(tmp_path)), files.discover_flat(spark, str(lake)).limit(0)
    name, profile = payloads.first_source({
        "none": None, "empty": empty, "invalid": invalid, "lake": files.discover_flat(spark, str(lake)),
        "embedded": files.read_payloads(spark, str(lake))})
    assert name == "lake" and {r.db_id for r in profile.files.collect()} == {"bank_one", "school-two", "collide"}
    assert payloads.first_source({"invalid": invalid}) is None and payloads.first_source({}) is None


def test_shared_folder_is_the_one_the_cluster_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert named.startswith("file:///") and shared_folder(spark) == named
    assert fresh_path(spark, "x").startswith(f"{named}/x-")


def test_replace_table(spark):
    load.replace_table(spark.range(3), "lakecat_replaced")
    load.replace_table(spark.range(2).selectExpr("id AS other"), "lakecat_replaced")
    stored = spark.table("lakecat_replaced")
    assert stored.columns == ["other"] and stored.count() == 2
    spark.sql("DROP TABLE lakecat_replaced")


def test_paths_off_the_mount_are_refused(spark):
    listed = spark.createDataFrame([("a", "s3://lake/a", 2000)], "db_id string, path string, length long")
    with pytest.raises(Exception, match="not on mounted storage"):
        files.with_header(listed).collect()
    errors = profile_databases(listed).errors.collect()
    assert [row.db_id for row in errors] == ["a"] and "read_payloads" in errors[0].error


def test_shared_folder_is_stable(spark):
    assert shared_folder(spark) == shared_folder(spark)
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_rule_sets():
    assert len(rules.SCORED_KEYWORDS) == 21
    assert sum(map(len, rules.SCORED_KEYWORDS.values())) == 150
    assert sum(map(len, rules.SCORED_TABLE_PATTERNS.values())) == 51
    assert set(rules.DOMAIN_DESCRIPTIONS) == set(rules.SCORED_KEYWORDS)


def test_inspection_shows_bytes_by_length(spark):
    df = spark.createDataFrame([(b"abc", "q" * 200)], "db_file binary, question string")
    found = {r.field: r for r in splits.inspect_sources({"s": df}).collect()}
    assert found["db_file"].flagged and found["db_file"].sample == "<bytes, length 3>"
    assert not found["question"].flagged and len(found["question"].sample) == 100 and found["question"].length == 200


@pytest.mark.parametrize("glob", ["*.{sqlite,db}", "*.db"])
def test_flat_glob(spark, lake, glob):
    found = {row.db_id for row in files.discover_flat(spark, str(lake), glob).collect()}
    assert ("school-two" in found) and ("bank_one" in found) == (glob != "*.db")
