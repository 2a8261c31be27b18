"""Golden rows of the rule, type and name functions."""

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from lakecat.functions import domains, naming, rules, text, typemap


def label(spark, function, names, *args):
    df = spark.createDataFrame([(name,) for name in names], "name string")
    return [row.domain for row in function(df, "name", *args).collect()]


def test_first_match(spark):
    golden = {
        "card_games": "sports", "debit_card_specializing": "transportation", "car_dealer_shop": "retail",
        "estate_office": "government", "webstore": "retail", "california_schools": "education",
        "student_club": "education", "retail": "retail", "financial": "general", "education": "general", "": "general",
        "BANK_Shop": "financial",
    }
    for function in (domains.with_first_match,):
        assert label(spark, function, golden, rules.FULL_RULES) == list(golden.values())


def test_scored_label_of_a_catalog(spark):
    names = spark.createDataFrame([
        ("shop", "database", "shop"), ("shop", "table", "customer_orders"),
        ("x", "database", "x"), ("x", "column", "zzz"),
        ("net", "database", "net"), ("net", "column", "network"), ("net", "column", "Academic"),
    ], "db_id string, kind string, name string")
    found = {row.db_id: (row.domain, row.score) for row in domains.scored_catalog_labels(names).collect()}
    # network speaks for technology before telecom, academic for education before research.
    assert found == {"shop": ("retail", 26), "x": ("general", 0), "net": ("education", 1)}


def plain_scores(name):
    lowered = name.lower()
    return {d: 10 * sum(word in lowered for word in words) for d, words in rules.SCORED_KEYWORDS.items()}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(
    st.sampled_from(["network", "Academic", "hr", "x", "é", "real_estate", "order", "rent", "FARM", "ing", "ß", "İ"]),
    max_size=6).map("".join), min_size=1, max_size=20))
def test_both_scored_forms_agree_with_a_plain_loop(spark, names):
    df = spark.createDataFrame([(i, name) for i, name in enumerate(names)], "i int, name string")
    expected = []
    for name in names:
        scores = plain_scores(name)
        best = max(scores.values())
        expected.append((max(scores, key=scores.get) if best else "general", best))
    for function in (domains.with_scored_label, domains.with_scored_text):
        assert [(r.domain, r.score) for r in function(df, "name").orderBy("i").collect()] == expected


def test_null_text_is_general(spark):
    df = spark.createDataFrame([(None,)], "name string")
    for function in (domains.with_scored_label, domains.with_scored_text):
        assert tuple(function(df, "name").select("domain", "score").first()) == ("general", 0)
    assert label(spark, domains.with_first_match, [None], rules.FULL_RULES) == ["general"]


LONG_TEXT = typemap.TEXT_TYPE
TYPES = [
    ("INTEGER", "INTEGER", "INTEGER", T.LongType(), T.LongType()),
    ("integer", "INTEGER", "INTEGER", T.LongType(), T.LongType()),
    ("INT", LONG_TEXT, LONG_TEXT, T.StringType(), T.StringType()),
    ("BIGINT", LONG_TEXT, LONG_TEXT, T.StringType(), T.StringType()),
    ("VARCHAR(50)", LONG_TEXT, "VARCHAR(50)", T.StringType(), T.StringType()),
    ("NVARCHAR(20)", LONG_TEXT, "NVARCHAR(20)", T.StringType(), T.StringType()),
    ("TINYTEXT", LONG_TEXT, LONG_TEXT, T.StringType(), T.StringType()),
    ("DECIMAL(5,4)", LONG_TEXT, "DECIMAL(5,4)", T.StringType(), T.DecimalType(5, 4)),
    ("DECIMAL", LONG_TEXT, "DECIMAL(15,2)", T.StringType(), T.DecimalType(15, 2)),
    ("NUMERIC", "NUMERIC(38,2)", LONG_TEXT, T.DecimalType(38, 2), T.StringType()),
    ("REAL", "FLOAT", "FLOAT", T.DoubleType(), T.DoubleType()),
    ("BOOLEAN", LONG_TEXT, LONG_TEXT, T.StringType(), T.StringType()),
    ("", LONG_TEXT, LONG_TEXT, T.StringType(), T.StringType()),
    ("DATE", LONG_TEXT, "DATE", T.StringType(), T.DateType()),
    ("DATETIME", LONG_TEXT, "DATE", T.StringType(), T.DateType()),
    ("TIMESTAMP", LONG_TEXT, "TIMESTAMP", T.StringType(), T.TimestampNTZType()),
    ("BLOB", "VARIANT", LONG_TEXT, T.BinaryType(), T.StringType()),
]


def test_type_maps(spark):
    df = spark.createDataFrame([(i, row[0]) for i, row in enumerate(TYPES)], "i int, declared string")
    found = df.select(
        "i", typemap.plain_type(F.col("declared")).alias("plain"), typemap.sized_type(F.col("declared")).alias("sized"),
    ).orderBy("i").collect()
    for row, (_, plain, sized, plain_spark, sized_spark) in zip(found, TYPES):
        assert (row.plain, row.sized) == (plain, sized)
        assert (typemap.spark_type(row.plain), typemap.spark_type(row.sized)) == (plain_spark, sized_spark)


def test_odd_decimals_are_text():
    assert typemap.spark_type("DECIMAL(99,2)") == T.StringType()
    assert typemap.spark_type("DECIMAL(2,5)") == T.StringType()
    assert typemap.spark_type("decimal( 7 )") == T.DecimalType(7, 0)


def test_ids_and_names(spark):
    df = spark.createDataFrame([(5, "a b/é-_9.db"), (1234567, "x")], "n long, s string")
    rows = df.select(
        naming.padded_id(F.col("n"), "q", 6), naming.clean_file_id(F.col("s")),
        naming.target_table_name(F.col("s"), F.lit("t"))).collect()
    assert [tuple(row) for row in rows] == [
        ("q_000005", "abé-_9db", "LAKE_A B/É-_9.DB_T"), ("q_1234567", "x", "LAKE_X_T")]


def test_column_names(spark):
    assert naming.normalise_columns(spark.range(1).selectExpr("id AS `a b-c`")).columns == ["A_B_C"]
    with pytest.raises(ValueError, match="collide"):
        naming.normalise_columns(spark.range(1).selectExpr("id AS `a b`", "id AS `a-b`"))


def test_colliding_ids(spark):
    ids = spark.createDataFrame([("a b",), ("ab",), ("c",), ("c",)], "db_id string")
    assert [tuple(row) for row in naming.colliding_ids(ids).collect()] == [("ab", 2, "a b", "ab")]


def test_percentage_of_nothing_is_null(spark):
    assert spark.range(1).select(text.percentage(F.lit(1), F.lit(0))).first()[0] is None
