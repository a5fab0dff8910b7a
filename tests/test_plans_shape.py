"""Plan shape: what every registered query must not contain, and what the
skew salting does to a shuffle join."""

import pytest
from pyspark.sql import functions as F

from revcast.checks.queries import QUERIES
from revcast.operators.joins import left_enrich

from conftest import SF001

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_or_python_in_plan(spark, name):
    plan = _plan(QUERIES[name](spark, SF001))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"


def test_filters_reach_the_scans(spark):
    df = QUERIES["billing_fact"](spark, SF001)
    plan = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThanOrEqual(fiscal_yyyymm,199601)" in plan
    assert "Not(In(accounting_rule, [BLP Ratable,DEFERRED-OPEN]))" in plan


def test_salting_spreads_null_keys_over_partitions(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        left = spark.range(4000).select(F.col("id"), F.when(F.col("id") % 4 != 0, F.lit(None))
                                        .otherwise(F.col("id")).alias("k"))
        right = spark.range(100).select((F.col("id") * 4).alias("k"), F.lit("v").alias("v"))

        def null_parts(df):
            return df.where(F.col("k").isNull()).select(F.spark_partition_id()).distinct().count()

        plain = left_enrich(left, right, "k", "k")
        salted = left_enrich(left, right, "k", "k", null_salt=16)
        assert "SortMergeJoin" in _plan(salted)
        assert null_parts(plain) == 1
        assert null_parts(salted) > 8
        assert plain.count() == salted.count() == 4000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_forecasts_from_the_fact_layer_barely_shuffle(spark):
    import re

    rev = _plan(QUERIES["revenue_forecast"](spark, SF001))
    assert "Exchange" not in rev
    tcv = _plan(QUERIES["tcv_forecast"](spark, SF001))
    assert len(re.findall(r"Exchange hashpartitioning", tcv)) <= 1


def test_extracts_are_not_shuffled_for_their_last_grouping(spark):
    """Where the party is joined by shuffle, its rows are grouped in place."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name)
    try:
        made = {}
        for q in ("contracted_tcv", "billing_fact", "recognised_deferred"):
            spark.conf.set(name, old)
            QUERIES[q](spark, SF001)  # lands what is small
            spark.conf.set(name, "-1")
            made[q] = _plan(QUERIES[q](spark, SF001))
    finally:
        spark.conf.set(name, old)
    for q, plan in made.items():
        assert "SortMergeJoin" in plan and "hashpartitioning(bill_to_party_id" in plan, q
        assert "hashpartitioning(PRODUCT_NUMBER" not in plan and "hashpartitioning(SEGMENT1" not in plan, q
