"""Join naming rule, rename/projection helpers, dedup, census, union."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from revcast.operators.aggregates import column_census
from revcast.operators.dedup import latest_per_key
from revcast.operators.joins import DeriveSpec, JoinSpec, enrich, left_enrich, parts_of
from revcast.operators.projection import (add_prefix, move_first, project_lenient, project_strict,
                                          rename_map, select_renamed)
from revcast.operators.sets import union_by_name

from conftest import rows


def test_suffix_rule(spark):
    left = spark.createDataFrame([(1, "a", "L")], "id int, k string, name string")
    right = spark.createDataFrame([("a", "R", "x")], "k string, name string, extra string")
    out = left_enrich(left, right, "k", "k")
    assert out.columns == ["id", "k", "name_x", "name_y", "extra"]
    out2 = left_enrich(left, right.withColumnRenamed("k", "rk"), "k", "rk", ("", "_R"))
    assert out2.columns == ["id", "k", "name", "rk", "name_R", "extra"]


def test_key_named_like_left_column_gets_suffix(spark):
    left = spark.createDataFrame([(1, "a", "u1")], "id int, k string, User_Id string")
    right = spark.createDataFrame([("u1", "Ann")], "User_Id string, User_Name string")
    out = left_enrich(left, right, "User_Id", "User_Id")
    assert out.columns == ["id", "k", "User_Id", "User_Name"]
    users = spark.createDataFrame([("u1", "Ann")], "User_Id string, User_Name string")
    twice = left_enrich(out.withColumn("owner", F.lit("u1")), users, "owner", "User_Id", ("_x", "_Opps"))
    assert twice.columns == ["id", "k", "User_Id_x", "User_Name_x", "owner", "User_Id_Opps", "User_Name_Opps"]


def test_duplicate_suffix_names_rejected(spark):
    left = spark.createDataFrame([(1, "a", "b")], "id int, n string, n_y string")
    right = spark.createDataFrame([(1, "c")], "id2 int, n string")
    with pytest.raises(ValueError):
        left_enrich(left, right, "id", "id2", ("", "_y"))


def test_role_playing_dimension_chain(spark):
    fact = spark.createDataFrame([(1, "u1", "u2", "u3")], "id int, a string, b string, c string")
    users = spark.createDataFrame([("u1", "Ann"), ("u2", "Bob"), ("u3", "Cy")], "User_Id string, User_Name string")
    specs = [JoinSpec("users", "a", "User_Id"), JoinSpec("users", "b", "User_Id", ("_x", "_B")),
             DeriveSpec(lambda d: d.withColumn("tag", F.lit("t"))),
             JoinSpec("users", "c", "User_Id", ("", "_C"), broadcast=True)]
    out = enrich(fact, {"users": users}, specs)
    r = out.first().asDict()
    assert (r["User_Name_x"], r["User_Name_B"], r["User_Name"], r["tag"]) == ("Ann", "Bob", "Cy", "t")


def test_rename_map_many_to_one(spark):
    df = spark.createDataFrame([("a", None, 1), (None, "b", 2)], "x string, y string, z int")
    out = rename_map(df, {"x": "t", "y": "t"})
    assert out.columns == ["t", "z"]
    assert rows(out) == [("a", 1), ("b", 2)]


def test_projections(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, `c d` int")
    assert project_lenient(df, ["c d", "zz", "a"]).columns == ["c d", "a"]
    with pytest.raises(KeyError):
        project_strict(df, ["a", "zz"])
    assert select_renamed(df, {"b": "B", "a": "A"}).columns == ["B", "A"]
    assert add_prefix(df, "P_").columns == ["P_a", "P_b", "P_c d"]
    assert move_first(df, "c d").columns == ["c d", "a", "b"]


def test_latest_per_key(spark):
    data = [("P1", "old", dt.date(2020, 1, 1)), ("P1", "new", dt.date(2020, 2, 1)),
            ("P2", "b", dt.date(2020, 1, 1)), ("P2", "a", dt.date(2020, 1, 1)),
            (None, "x", dt.date(2021, 1, 1)), ("P3", None, dt.date(2020, 1, 1)), ("P3", "c", dt.date(2020, 1, 1)),
            ("P4", "nomonth", None), ("P4", "dated", dt.date(2019, 1, 1))]
    df = spark.createDataFrame(data, "p string, o string, m date")
    out = latest_per_key(df, "p", "m", ["o"])
    assert rows(out) == [("P1", "new"), ("P2", "a"), ("P3", None), ("P4", "dated")]


def test_column_census(spark):
    df = spark.createDataFrame([("1", "2.5", "2020-01-01", "x"), (None, "3", "2020-01-02 10:00:00", "y")],
                               "a string, b string, c string, d string")
    got = {(r[0], r[1]): r[2] for r in column_census(df).collect()}
    assert got == {("a", "int"): 1, ("a", "null"): 1, ("b", "float"): 1, ("b", "int"): 1,
                   ("c", "date"): 2, ("d", "str"): 2}


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, k int")
    out = union_by_name([a, b])
    assert out.columns == ["k", "a", "b"]
    assert rows(out) == [(1, "x", None), (2, None, "y")]


def test_size_estimate_and_bounded_broadcast(spark):
    from revcast.operators.joins import bounded_broadcast, estimated_bytes

    small = spark.range(10)
    assert estimated_bytes(small) is not None
    assert estimated_bytes(spark.createDataFrame([(1, "a")], "k int, v string")) > 1 << 40  # unknown
    hinted = bounded_broadcast(small, ceiling=1 << 30)
    assert "broadcast" in hinted._jdf.queryExecution().analyzed().toString().lower()
    kept = bounded_broadcast(small, ceiling=0)
    assert "broadcast" not in kept._jdf.queryExecution().analyzed().toString().lower()


def test_parts_of_bounds_the_rows_of_a_task(spark):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = spark.range(1000 * (least + 3))
    assert parts_of(df, 1000) == least + 3 and parts_of(df, 1 << 40) == least
    kept = df.repartition(parts_of(df, 1000), "id")
    assert kept.rdd.getNumPartitions() == least + 3  # adaptive execution puts none together
