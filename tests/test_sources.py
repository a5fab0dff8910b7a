"""Sources and sinks: CRM JSON exports, nested parent, directory loader,
dated snapshots."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import types as T

from revcast.sources.readers import flatten_parent, load_directory, read_crm_export
from revcast.sources.sinks import read_snapshot, write_layer, write_snapshot

from conftest import rows


def _tmp():
    return tempfile.mkdtemp(prefix="revcast-src-")


def test_crm_export_with_nested_parent(spark):
    d = _tmp()
    recs = [{"attributes": {"type": "Opportunity"}, "Opportunity__c": "OP-1", "Account": {"Id": "A1"}},
            {"attributes": {"type": "Opportunity"}, "Opportunity__c": "OP-2", "Account": None}]
    with open(os.path.join(d, "part.json"), "w") as fh:
        fh.write("\n".join(json.dumps(r) for r in recs))
    schema = T.StructType([
        T.StructField("attributes", T.StructType([T.StructField("type", T.StringType())])),
        T.StructField("Opportunity__c", T.StringType()),
        T.StructField("Account", T.StructType([T.StructField("Id", T.StringType())]))])
    df = read_crm_export(spark, d, schema)
    assert df.columns == ["Opportunity__c", "Account"]
    flat = flatten_parent(df, "Opportunity__c", "Account", "Id", "OppsAcct_Opportunity__c", "OppsAcct_Account")
    assert rows(flat) == [("OP-1", "A1"), ("OP-2", None)]
    pref = read_crm_export(spark, d, schema, prefix="Opps_")
    assert pref.columns == ["Opps_Opportunity__c", "Opps_Account"]


def test_directory_loader_csv_latin1_skips_hist(spark):
    d = _tmp()
    with open(os.path.join(d, "Ref_User.csv"), "wb") as fh:
        fh.write("Id,Name\nU1,Jos\xe9\n".encode("iso-8859-1"))
    os.makedirs(os.path.join(d, "hist"))
    schema = T.StructType([T.StructField("Id", T.StringType()), T.StructField("Name", T.StringType())])
    got = load_directory(spark, d, {"Ref_User": schema}, fmt="csv")
    assert list(got) == ["Ref_User"]
    assert rows(got["Ref_User"]) == [("U1", "José")]


def test_layers_and_snapshots(spark):
    root = _tmp()
    df = spark.createDataFrame([(1, 10.0), (2, 20.0)], "k int, v double")
    paths = write_layer({"fact_a": df}, root, "fact")
    assert rows(spark.read.parquet(paths["fact_a"])) == [(1, 10.0), (2, 20.0)]
    snap = os.path.join(root, "fc")
    write_snapshot(df, snap, dt.date(2020, 1, 1), sort_cols=("k",))
    write_snapshot(df.where("k = 1"), snap, dt.date(2020, 1, 2))
    write_snapshot(df.where("k = 2"), snap, dt.date(2020, 1, 2))  # replaces that day only
    assert read_snapshot(spark, snap).count() == 3
    assert rows(read_snapshot(spark, snap, "2020-01-02"), "k") == [(2,)]


def test_sql_extracts_over_views(spark):
    import pytest
    from pyspark.errors import AnalysisException

    from revcast.sources.readers import read_sql_extracts

    spark.createDataFrame([(1, 1001, " OP-1 "), (2, 1002, None)],
                          "header_id long, order_number long, attribute11 string") \
        .createOrReplaceTempView("order_headers_v")
    sql = ("SELECT header_id AS ORDER_HEADER_ID, order_number AS ORDER_NUMBER, "
           "trim(attribute11) AS OPPORTUNITY_ID, 'x' AS EXTRA FROM order_headers_v "
           "WHERE attribute11 IS NOT NULL")
    got = read_sql_extracts(spark, {"reforderopp": {
        "sql": sql, "finalcols": ["ORDER_HEADER_ID", "OPPORTUNITY_ID", "ORDER_NUMBER"]}})
    assert got["reforderopp"].columns == ["ORDER_HEADER_ID", "OPPORTUNITY_ID", "ORDER_NUMBER"]
    assert rows(got["reforderopp"]) == [(1, "OP-1", 1001)]
    with pytest.raises(AnalysisException):
        read_sql_extracts(spark, {"x": {"sql": sql, "finalcols": ["MISSING"]}})


def test_csv_fields_with_quotes_separators_and_line_breaks(spark):
    import csv

    d = _tmp()
    values = ['plain', 'say "hi", then', 'two\nlines', 'é', 'tail"', None]
    with open(os.path.join(d, "notes.csv"), "w", newline="", encoding="iso-8859-1") as fh:
        w = csv.writer(fh)
        w.writerow(["k", "note", "n", "last"])
        for k, v in enumerate(values):  # whole numbers with a fraction of zero beside missing ones
            w.writerow([k, v, "" if k % 2 else f"{k}.0", f"end{k}"])
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("n", T.LongType())])
    got = sorted(tuple(r) for r in load_directory(spark, d, {"notes": schema}, fmt="csv")["notes"].collect())
    assert got == [(k, v, None if k % 2 else k, f"end{k}") for k, v in enumerate(values)]


def test_flat_parent_files(spark):
    from revcast.plans.crm import opportunity_account_ref

    rows_ = [("OP-1", "A1"), ("OP-2", None)]
    for names in ("Opportunity__c string, Account string", "OppsAcct_Opportunity__c string, OppsAcct_Account string"):
        assert rows(opportunity_account_ref(spark.createDataFrame(rows_, names))) == rows_


def test_schemas_match_the_derived_tables(spark):
    from conftest import SF001
    from revcast.sources.driver_tables import ORDER_BASE_TABLES, DriverCatalog
    from revcast.sources.schemas import crm_schemas, order_schemas

    dc = DriverCatalog(spark, SF001)
    for n in ORDER_BASE_TABLES:
        assert [(f.name, f.dataType) for f in getattr(dc, n)().schema] == [
            (f.name, f.dataType) for f in order_schemas()[n]], n
    for n, df in dc.crm_objects().items():
        assert df.columns == crm_schemas()[n].names, n


def test_input_fingerprint_sees_nested_files(spark, tmp_path):
    from revcast.sources.landing import frame_fingerprint, input_fingerprint

    path = str(tmp_path / "t")
    spark.range(4).selectExpr("id", "id % 2 as p").write.partitionBy("p").parquet(path)
    one, frame = input_fingerprint(spark, [path]), frame_fingerprint(spark.read.parquet(path))
    spark.range(1).write.parquet(path + "/p=1/more")
    assert input_fingerprint(spark, [path]) != one
    assert frame_fingerprint(spark.read.parquet(path).where("id > 1")) != frame
    a, b = spark.createDataFrame([(1, None)], "k int, v int"), spark.createDataFrame([(None, 1)], "k int, v int")
    assert frame_fingerprint(a) != frame_fingerprint(b) == frame_fingerprint(
        spark.createDataFrame([(None, 1)], "k int, v int"))


@pytest.mark.parametrize("kind", ["skewed", "date", "text", "one value", "nulls"])
def test_ranges_are_disjoint_complete_and_balanced(spark, kind):
    from revcast.sources.readers import range_bounds, range_predicates, read_ranges

    value = {"skewed": "id * id", "date": "date_add(DATE '2020-01-01', cast(id % 700 as int))",
             "text": "concat('k', char(39), id % 900)", "one value": "cast(7 as bigint)", "nulls": "cast(null as int)"}[kind]
    df = spark.range(4000).selectExpr("id", f"CASE WHEN id % 5 <> 0 THEN {value} END AS `the key`")
    parts = read_ranges(df, "the key", 8)
    ids = [sorted(r.id for r in p.collect()) for p in parts]
    assert sorted(sum(ids, [])) == list(range(4000))
    assert ids[0] == [i for i in range(4000) if i % 5 == 0 or kind == "nulls"]
    if kind in ("skewed", "date", "text"):
        assert len(parts) == 9 and max(map(len, ids[1:])) <= 2 * 3200 / 8
    assert range_predicates("c", []) == ["c IS NULL", "c IS NOT NULL"]
    assert range_bounds(df, "the key", 1) == []


def test_bounds_query_of_a_database(spark):
    """The SQL that asks a database for the bounds, run over a view."""
    from revcast.sources.readers import bounds_query, range_predicates

    spark.range(1000).selectExpr("CASE WHEN id % 10 <> 0 THEN id * id END AS c").createOrReplaceTempView("bounded")
    bounds = sorted(r[0] for r in spark.sql(bounds_query("SELECT c FROM bounded", "c", 4)).collect())
    sizes = [spark.sql(f"SELECT * FROM bounded WHERE {p}").count() for p in range_predicates("c", bounds[1:])]
    assert sizes == [100, 225, 225, 225, 225]
