"""Shapes of the physical plans that scale depends on."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lakecat import bindings
from lakecat.functions.domains import with_first_match, with_scored_label, with_scored_text
from lakecat.functions.rules import FULL_RULES

QUERIES = entry.queries()
FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_labels_need_no_exchange(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for df in (with_scored_label(documents, "source"), with_scored_text(documents, "text"),
               with_first_match(documents, "source", FULL_RULES)):
        assert "Exchange" not in plan_of(df)


@pytest.mark.parametrize("name", ["l_first_match_questions", "l_first_match_full", "l_first_match_typed", "l_first_match_smoke"])
def test_first_match_needs_no_python(spark, name):
    assert "Python" not in plan_of(QUERIES[name](spark, FOLDER))


def test_relationships_fold_before_their_distinct_counts(spark):
    lines = plan_of(QUERIES["v_relationships"](spark, FOLDER)).splitlines()
    expand = next(i for i, line in enumerate(lines) if "Expand" in line)
    assert any("HashAggregate" in line for line in lines[expand + 1:])


def test_top_rows_meet_keys_only(spark):
    assert "LeftSemi" in plan_of(QUERIES["m_top_balances"](spark, FOLDER))


def test_text_is_matched_once_and_without_python(spark):
    plan = plan_of(QUERIES["l_scored_text"](spark, FOLDER))
    assert "Python" not in plan and sum("regexp_extract_all" in line for line in plan.splitlines() if "Project" in line) == 1


def test_first_records_need_no_sort(spark):
    plan = plan_of(QUERIES["s_slice"](spark, FOLDER))
    assert "Sort" not in plan and "Exchange hash" not in plan and "Exchange range" not in plan


def test_substring_tests_are_contains(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert "Contains" in plan_of(documents.filter(F.col("text").like("%the%")))


@pytest.mark.parametrize("name", ["v_comprehensive", "v_schema_overview", "v_availability", "v_relationships",
                                  "d_customer_summary", "g_avg_since", "g_has_both"])
def test_facts_are_folded_before_the_join(spark, name):
    """Reading the plan from the root: the join comes first, an aggregate of the facts lies below it."""
    lines = plan_of(QUERIES[name](spark, FOLDER)).splitlines()
    depth = {text: min((i for i, line in enumerate(lines) if text in line), default=None)
             for text in ("Join", "Aggregate")}
    last_aggregate = max(i for i, line in enumerate(lines) if "Aggregate" in line)
    assert depth["Join"] is not None and last_aggregate > depth["Join"]


@pytest.mark.parametrize("name, columns", [
    ("v_comprehensive", "o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_orderpriority:string"),
    ("q_distinct_db", "source:string"),
    ("q_loaded", "o_orderstatus:string"),
    ("q_difficulty", "doc_id:bigint"),
])
def test_scans_read_only_what_they_need(spark, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plan_of(QUERIES[name](spark, FOLDER))


def test_filters_reach_the_scan(spark):
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan_of(
        QUERIES["w_since"](spark, FOLDER))
    assert "In(p_type, [PROMO,SMALL])" in plan_of(QUERIES["r_in_top1"](spark, FOLDER))


@pytest.mark.parametrize("name", sorted(bindings.QUERIES))
def test_no_cross_joins(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
