"""One row per branch of every Column rule (X1-X24), hand-made."""

import datetime as dt

from pyspark.sql import functions as F

from revcast.functions import rules as R
from revcast.functions.fiscal import fiscal_period, fiscal_year_label
from revcast.functions.semantics import product_key, trim_to_null


def test_fiscal_period_and_year(spark):
    days = [dt.date(2017, 6, 30), dt.date(2017, 7, 1), dt.date(2017, 12, 31), dt.date(2018, 1, 1),
            dt.date(2016, 2, 29), None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = df.select(fiscal_period("d").alias("p")).withColumn("fy", fiscal_year_label("p")).collect()
    assert [tuple(r) for r in got] == [(201712, "FY17"), (201801, "FY18"), (201806, "FY18"),
                                        (201807, "FY18"), (201608, "FY16"), (None, None)]


def test_fiscal_period_parses_text(spark):
    df = spark.createDataFrame([("2017-07-15",)], "s string")
    assert df.select(fiscal_period("s")).first()[0] == 201801


def test_project_stage_code(spark):
    stages = ["Scheduled", "Unscheduled", "Soft Scheduled", "Project Initiated", "Closed", "Canceled",
              "On Hold", None]
    df = spark.createDataFrame([(s,) for s in stages], "s string")
    got = [r[0] for r in df.select(R.project_stage_code("s")).collect()]
    assert got == ["Schl", "UnSchl", "SoftSchl", "ProjInit", "Closed", "Canceled", "NA", "NA"]


def test_revenue_code(spark):
    data = [("1", "NA"), ("2", "NA"), ("3", "NA"), ("Opportunity Schedule", "NA"), ("Manual - SD", "Schl"),
            ("Manual - SD", "NA"), ("PO Hold", "NA"), ("9", "NA"), (None, "NA")]
    df = spark.createDataFrame(data, "t string, s string")
    got = [r[0] for r in df.select(R.revenue_code("t", "s")).collect()]
    assert got == ["RecRev", "DefRev", "BillEv", "PipeLn", "Schl", "NA", "POH", "unmapped", "unmapped"]


def test_revenue_code_numeric_ids(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "t int")
    got = [r[0] for r in df.select(R.revenue_code("t", F.lit("NA"))).collect()]
    assert got == ["RecRev", "DefRev", "BillEv"]


def test_inclusion_flag_branches(spark):
    data = [(201712, "RecRev", None), (201801, "RecRev", None), (201712, "BillEv", None),
            (201801, "BillEv", None), (201801, "Schl", None), (None, "PipeLn", 0.0),
            (None, "PipeLn", 50.0), (None, "PipeLn", None), (None, "RecRev", None), (201801, "POH", 10.0)]
    df = spark.createDataFrame(data, "p int, c string, pr double")
    got = [r[0] for r in df.select(R.inclusion_flag("p", "c", "pr")).collect()]
    assert got == ["Yes", "Yes", "No", "Yes", "Yes", "No", "Yes", "No", "No", "No"]


def test_weighted(spark):
    data = [("PipeLn", 0.0, 100.0), ("PipeLn", 50.0, 100.0), ("PipeLn", 100.0, -20.0),
            ("PipeLn", None, 100.0), ("BillEv", 50.0, 100.0), ("BillEv", None, None)]
    df = spark.createDataFrame(data, "c string, p double, a double")
    got = [r[0] for r in df.select(R.weighted("a", "p", R.is_pipeline("c"))).collect()]
    assert got == [0.0, 50.0, -20.0, None, 100.0, None]


def test_account_fallback_and_source(spark):
    data = [("o", None, None), (None, "b", None), (None, None, "p"), (None, None, None), ("o", "b", None)]
    df = spark.createDataFrame(data, "o string, b string, p string")
    got = [tuple(r) for r in df.select(R.account_fallback("o", "b", "p"), R.account_source("o", "b", "p")).collect()]
    assert got == [("o", "opp"), ("b", "bill2"), ("p", "prnt"), ("unmapped", "unmapped"), ("o", "opp")]


def test_tcv_rules(spark):
    data = [("actual", 201801, 201905, 10.0, 99.0, 50.0), ("unw_pl", 201801, 201905, 10.0, 40.0, 50.0),
            ("sf_non_tcv", None, 201905, None, None, 50.0), ("unw_pl", None, 201905, None, 40.0, None)]
    df = spark.createDataFrame(data, "src string, trx int, close int, amt double, pl double, prob double")
    df = df.withColumn("unw", R.unweighted_tcv("src", "amt", "pl"))
    got = [tuple(r) for r in df.select(
        R.tcv_period("src", "trx", "close"), "unw", R.weighted_tcv("src", "unw", "prob"),
        R.pipeline_weighted_tcv("src", "unw", "prob")).collect()]
    assert got == [(201801, 10.0, 10.0, 0.0), (201905, 40.0, 20.0, 20.0), (201905, 0.0, 0.0, 0.0),
                   (201905, 40.0, None, None)]


def test_owner(spark):
    df = spark.createDataFrame([("PipeLn", "opp", "acct"), ("RecRev", "opp", "acct"), ("PipeLn", None, "a")],
                               "c string, o string, a string")
    got = [r[0] for r in df.select(R.owner(R.is_pipeline("c"), "o", "a")).collect()]
    assert got == ["opp", "acct", None]


def test_revenue_type_by_date(spark):
    df = spark.createDataFrame([(dt.date(2020, 5, 30),), (dt.date(2020, 5, 31),), (None,)], "d date")
    got = [r[0] for r in df.select(R.revenue_type_by_date("d", F.lit("2020-05-31 12:00:00"))).collect()]
    assert got == [1, 2, 2]


def test_hold_category(spark):
    df = spark.createDataFrame([("Y",), ("N",), (None,)], "f string")
    assert [r[0] for r in df.select(R.hold_category("f")).collect()] == ["PO Hold", None, None]


def test_product_key_nulls(spark):
    df = spark.createDataFrame([("A1", "EB", "EN"), ("A1", None, "EN"), ("A1", "EB", None), (None, None, None)],
                               "n string, f string, l string")
    got = [r[0] for r in df.select(product_key("n", "f", "l")).collect()]
    assert got == ["A1-EB-EN", "A1--EN", "A1-EB-", "--"]


def test_trim_to_null(spark):
    vals = ["  OP-1", "OP-2  ", "OP 3", "\tOP-4\t", "   ", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(trim_to_null("s")).collect()]
    assert got == ["OP-1", "OP-2", "OP 3", "OP-4", None, None]


def test_overrides(spark):
    df = spark.createDataFrame([("ClOpp-1", "x", None, 5.0, 7.0), ("OP-2", None, "L", None, 7.0),
                                (None, "y", None, None, 7.0)],
                               "id string, line string, line_num string, line_amt double, amt double")
    got = [tuple(r) for r in df.select(
        R.apply_overrides("id", {"ClOpp-1": "CLOpp-1"}), R.override_if_present("line", "id"),
        R.override_if_key_present("line_num", "line_amt", "amt")).collect()]
    assert got == [("CLOpp-1", "x", 7.0), ("OP-2", "OP-2", None), (None, "y", 7.0)]


def test_milestone_type_name(spark):
    df = spark.createDataFrame([("012E0000000fBNOIA2",), ("012E0000000fBNPIA2",), ("0120L000000NQCGQA4",),
                                ("other",), (None,)], "t string")
    got = [r[0] for r in df.select(R.milestone_type_name("t")).collect()]
    assert got == ["Delivery", "Revenue", "Task", "other", None]
