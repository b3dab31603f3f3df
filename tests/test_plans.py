"""Plans that must hold at any size."""

import pytest
from conftest import as_set, plan_of
from pyspark.sql import functions as F

from casemill.operators import load
from casemill.operators.taxonomy import Domain
from casemill.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
RUN_WHILE_BUILT = {"classify_callable", "classify_model"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - RUN_WHILE_BUILT))
def test_no_pairs_and_no_python(spark, name):
    """With broadcasts off, every join is an equi-join, and nothing leaves the JVM."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES[name](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "Python" not in plan and "MapInPandas" not in plan and "ArrowEval" not in plan
    assert "BroadcastExchange" not in plan


def test_only_needed_columns_are_read(spark):
    plan = plan_of(QUERIES["cases_per_month"](spark, SF))
    assert plan.count("FileScan") == 1
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in plan


def test_hot_key_is_exact(spark):
    """A third of all rows under one key: one insert, all others counted as existing."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("case_id"),
        F.col("id").alias("position"),
    )
    fresh = load.new_rows(rows, rows.limit(0), [F.col("position")])
    assert fresh.count() == 20_001
    assert as_set(fresh.filter("case_id = 'hot'"), "position") == {(0,)}
    counts = load.load_accounting(load.tag_rejects(rows), rows.limit(0)).head()
    assert tuple(counts) == (30_000, 20_001, 9_999, 0)


def test_a_domain_needs_categories():
    with pytest.raises(ValueError, match="no categories"):
        Domain("empty", ())
