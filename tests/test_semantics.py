"""Null semantics N1-N5, N12 and the exclusion / anti-join rules."""

from pyspark.sql import functions as F

from revcast.functions.semantics import (exclude_drop_null, exclude_keep_null, in_list_keep_null)
from revcast.operators.aggregates import sum_by
from revcast.operators.joins import anti_join, fanout_report, left_enrich

from conftest import rows


def test_null_key_matches_null_key(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "zz")], "id int, k string")
    right = spark.createDataFrame([("a", "A"), (None, "N")], "k string, v string")
    out = left_enrich(left, right, "k", "k")
    assert rows(out, "id", "v") == [(1, "A"), (2, "N"), (3, None)]


def test_plain_join_when_not_null_safe(spark):
    left = spark.createDataFrame([(1, "a"), (2, None)], "id int, k string")
    right = spark.createDataFrame([("a", "A"), (None, "N")], "k string, v string")
    out = left_enrich(left, right, "k", "k", null_safe=False)
    assert rows(out, "id", "v") == [(1, "A"), (2, None)]


def test_null_left_without_null_right(spark):
    left = spark.createDataFrame([(1, None)], "id int, k string")
    right = spark.createDataFrame([("a", "A")], "k string, v string")
    assert rows(left_enrich(left, right, "k", "k"), "id", "v") == [(1, None)]


def test_duplicate_right_keys_fan_out_and_are_reported(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "id int, k string")
    right = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    assert left_enrich(left, right, "k", "k").count() == 3
    rep = fanout_report(left, right, "k", "k")
    assert rows(rep) == [("a", 2, 1)]


def test_exclude_keep_and_drop_null(spark):
    df = spark.createDataFrame([("x",), ("y",), (None,)], "c string")
    assert rows(df.where(exclude_keep_null("c", ["x"]))) == [(None,), ("y",)]
    assert rows(df.where(exclude_drop_null("c", ["x"]))) == [("y",)]
    assert rows(df.where(exclude_keep_null("c", ["x", None]))) == [("y",)]


def test_in_list_keep_null(spark):
    df = spark.createDataFrame([("x",), (None,)], "c string")
    got = [r[0] for r in df.select(in_list_keep_null("c", ["x"])).collect()]
    assert got == [True, False]


def test_anti_join_null_semantics(spark):
    opps = spark.createDataFrame([("OP1",), ("OP2",), (None,)], "n string")
    reported = spark.createDataFrame([("OP1",)], "r string")
    assert rows(anti_join(opps, reported, "n", "r")) == [(None,), ("OP2",)]
    reported_null = spark.createDataFrame([("OP1",), (None,)], "r string")
    assert rows(anti_join(opps, reported_null, "n", "r")) == [("OP2",)]


def test_group_keys_null_dropped_and_zero_sums_dropped(spark):
    df = spark.createDataFrame(
        [("o1", "f1", 5.0), ("o1", "f1", -5.0), ("o2", "f1", 3.0), (None, "f1", 9.0), ("o3", None, 9.0),
         ("o4", "f1", None)], "o string, f string, a double")
    out = sum_by(df, ["o", "f"], "a", drop_null_keys=True, nonzero=True)
    assert rows(out) == [("o2", "f1", 3.0)]
    kept = sum_by(df, ["o", "f"], "a")
    assert kept.where(F.col("o").isNull()).count() == 1


def test_null_salt_keeps_null_safe_result(spark):
    left = spark.createDataFrame([(i, None if i % 2 else "a") for i in range(40)], "id int, k string")
    right = spark.createDataFrame([("a", "A"), (None, "N1"), (None, "N2")], "k string, v string")
    plain = rows(left_enrich(left, right, "k", "k"), "id", "v")
    salted = rows(left_enrich(left, right, "k", "k", null_salt=8), "id", "v")
    assert plain == salted
    assert len(salted) == 20 + 20 * 2


def test_unique_guard_in_chain(spark):
    import pytest

    from revcast.operators.joins import JoinSpec, enrich

    left = spark.createDataFrame([(1, "a")], "id int, k string")
    ok = spark.createDataFrame([("a", 1)], "k string, v int")
    dup = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    assert enrich(left, {"r": ok}, [JoinSpec("r", "k", "k", unique=True)]).count() == 1
    with pytest.raises(ValueError, match="duplicate keys"):
        enrich(left, {"r": dup}, [JoinSpec("r", "k", "k", unique=True)])
