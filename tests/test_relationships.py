"""The relationship view: tasks that grow with the facts, and counts with nulls and repeats."""

from lakecat.plans import views


def test_a_task_folds_a_bounded_number_of_facts(spark, monkeypatch):
    monkeypatch.setattr(views, "FACTS_PER_TASK", 10)
    facts = [("a", f"s{i % 7}", f"t{i % 5}") for i in range(70)] + [
        ("a", None, "t0"), ("a", "s0", None), ("b", None, None), ("b", None, None), (None, "s", "t"), ("none", "s", "t")]
    fks = spark.createDataFrame(facts, "db_id string, source_table string, target_table string")
    databases = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "x"), ("b", None)], "db_id string, domain string")
    found = views.relationship_complexity(fks, databases)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert ", 8), REPARTITION_BY_NUM" in plan and ", 16), REPARTITION_BY_NUM" in plan
    assert {tuple(row) for row in found.collect()} == {("a", "x", 144, 7, 5), ("a", "y", 72, 7, 5), ("b", None, 2, 0, 0)}


def test_no_facts_give_no_rows(spark):
    fks = spark.createDataFrame([], "db_id string, source_table string, target_table string")
    databases = spark.createDataFrame([("a", "x")], "db_id string, domain string")
    assert views.relationship_complexity(fks, databases).collect() == []
