"""End to end on the driver tables: every registered query against its SQL
restatement (DuckDB) at sf0.001, plus invariants of the forecasts."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from revcast.checks.oracle_sql import oracle_queries
from revcast.checks.queries import QUERIES
from revcast.plans.pipeline import driver_run

from conftest import SF001
from oracle_compare import TABLES, frame_hash


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def run(spark):
    return driver_run(spark, SF001)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "fc_filter"


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle_queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    sdf = QUERIES[name](spark, SF001)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(oracle_queries()[name])
    dcols = [c[0] for c in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert frame_hash(srows, sdf.columns)[0] == frame_hash(drows, dcols)[0]
    # as pandas frames too: same dtypes on both sides
    sp, dp = sdf.toPandas(), duck.execute(oracle_queries()[name]).df()
    assert {c: str(sp[c].dtype) for c in sp.columns} == {c: str(dp[c].dtype) for c in dp.columns}


def test_weighted_never_exceeds_unweighted(run):
    fc = run.fcrev
    bad = fc.where((F.col("unwfc") >= 0) & F.col("Opp_Prob").between(0, 100) & (F.col("wfc") > F.col("unwfc")))
    assert bad.count() == 0


def test_pipeline_split_sums_back(run):
    fc = run.fctcv
    parts = fc.where(F.col("src") == "unw_pl").agg(
        F.sum("w_fc_tcv").alias("w"), F.sum("w_pl_tcv").alias("wp")).first()
    assert parts["w"] == pytest.approx(parts["wp"])


def test_unreported_disjoint_from_reported(run):
    fc = run.fctcv
    rep = fc.where(F.col("src") != "sf_non_tcv").select("Opp_Num").distinct()
    unrep = fc.where(F.col("src") == "sf_non_tcv").select("Opp_Num")
    assert unrep.join(rep, unrep.Opp_Num.eqNullSafe(rep.Opp_Num)).count() == 0


def test_chain_keeps_rows_when_right_keys_unique(run):
    tcv = run.order_sources["tcv"]
    assert run.attributed[1].count() >= tcv.count()
    # every enrichment step but the null-key ones has unique right keys
    refs = run.crm_refs
    for name, key in [("Ref_BillParty", "Acct_Party_ID__c"), ("Ref_Acct", "Acct_Id"), ("Ref_User", "User_Id"),
                      ("Ref_Offr", "Offr_Product_Number__c")]:
        df = refs[name]
        assert df.count() == df.select(key).distinct().count(), name


def test_write_forecasts_snapshots(spark, run, tmp_path):
    from revcast.plans.pipeline import write_forecasts
    from revcast.sources.sinks import read_snapshot

    paths = write_forecasts(run, str(tmp_path), "2020-01-31")
    write_forecasts(run, str(tmp_path), "2020-02-29", facts=False)
    fc = read_snapshot(spark, paths["fc"], "2020-01-31")
    assert fc.count() == run.fcrev.count()
    assert read_snapshot(spark, paths["tcv"]).select("snapshot_date").distinct().count() == 2
    assert spark.read.parquet(paths["fullcrm_revfacts"]).count() == run.fact_trx.count()


def test_dimension_first_crm_join_equals_sequential_chain(spark):
    from revcast.plans import crm
    from revcast.sources.driver_tables import DriverCatalog

    objs = DriverCatalog(spark, SF001).crm_objects()
    seq = crm.transaction_fact(objs, chain=crm.CRM_CHAIN)
    dim = crm.transaction_fact(objs)
    assert seq.columns == dim.columns
    assert seq.exceptAll(dim).count() == 0 and dim.exceptAll(seq).count() == 0


def test_cli_runs_forecasts_from_landed_directories(spark, tmp_path):
    import dataclasses
    import json

    from revcast.__main__ import main
    from revcast.plans.attribution import ORDER_CHAIN, chain_from_config
    from revcast.sources.driver_tables import DriverCatalog
    from revcast.sources.sinks import read_snapshot, write_layer

    dc = DriverCatalog(spark, SF001)
    root = str(tmp_path)
    order = dc.order_base()
    order["zero_party_dates"] = dc.zero_party_date_rules()
    order["zero_orders"] = dc.zero_order_rules()
    write_layer(order, root + "/in", "raw")
    write_layer(dc.crm_objects(), root + "/in", "source")
    cfg = dataclasses.asdict(dc.p)
    cfg_path = root + "/cfg.json"
    with open(cfg_path, "w") as fh:
        json.dump(cfg, fh)
    paths = main(["--order-dir", root + "/in/raw", "--crm-dir", root + "/in/source", "--out", root + "/out",
                  "--snapshot-date", "1999-06-30", "--config", cfg_path], spark=spark)
    fc = read_snapshot(spark, paths["fc"], "1999-06-30").drop("snapshot_date")
    assert fc.count() > 0
    expected = driver_run(spark, SF001, landed=False).fcrev
    by_text = lambda df: sorted(tuple(map(str, r)) for r in df.select(*sorted(expected.columns)).collect())
    assert by_text(fc) == by_text(expected)
    # the same run from CSV, with a fact layer and all output layers
    for side, frames in (("raw", order), ("source", dc.crm_objects())):
        for n, df in frames.items():
            flat = df.withColumn("Account", F.col("Account.Id")) if n == "Ref_Opps_Acct" else df
            flat.write.csv(f"{root}/csv/{side}/{n}", header=True, quote='"', escape='"', encoding="ISO-8859-1",
                           ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    paths = main(["--order-dir", root + "/csv/raw", "--crm-dir", root + "/csv/source", "--out", root + "/out2",
                  "--snapshot-date", "1999-06-30", "--config", cfg_path, "--format", "csv", "--layers",
                  "--fact-root", root + "/facts", "--quarantine", root + "/aside", "--sweep-days", "1"], spark=spark)
    assert spark.read.parquet(root + "/aside/order/*").count() == 0
    assert by_text(read_snapshot(spark, paths["fc"], "1999-06-30")) == by_text(expected)
    assert {"Ref_Acct", "revfact", "fullorder_revfacts"} <= set(paths)
    # the original's JSON join list builds the same chain
    entries = [{"src": "func", "right": "buff"} if not hasattr(s, "right") else
               {"src": "sf", "right": s.right, "left_on": s.left_on, "right_on": s.right_on,
                "suf1": s.suffixes[0], "suf2": s.suffixes[1]} for s in ORDER_CHAIN]
    chain = chain_from_config(entries)
    assert [getattr(s, "right", None) for s in chain] == [getattr(s, "right", None) for s in ORDER_CHAIN]


def test_driver_forecasts_exposes_every_table(spark):
    from revcast import driver_forecasts

    t = driver_forecasts(spark, SF001)
    for name in ("tcv", "billev", "defrecrev", "reforderopp", "poh", "revfact", "Fact_Trx", "Fact_Tcvpl",
                 "Ref_BillParty", "Ref_Prnt", "Ref_Offr", "Ref_Opps", "Ref_Opps_Acct", "rev_attributed",
                 "tcv_attributed", "fcrev", "fctcv"):
        assert name in t, name
    assert t["fcrev"].columns[0] == "fc_filter"
    assert t["fctcv"].count() > 0


def test_one_fact_root_serves_changed_parameters_inputs_and_rules(spark, tmp_path):
    """A run reads the fact layer of another only if nothing differs."""
    import dataclasses

    from revcast.plans.pipeline import ForecastRun
    from revcast.sources.driver_tables import DriverCatalog

    dc = DriverCatalog(spark, SF001)
    base = dc.order_base()

    def billed(root=None, order=base, cfg=dc.p, rules=None):
        run = ForecastRun(order, dc.crm_objects(), cfg, dc.zero_party_date_rules(), rules or dc.zero_order_rules(), root)
        return run, sorted(map(str, run.order_sources["billev"].collect())), sorted(
            map(str, run.order_sources["tcv"].collect()))

    later = dataclasses.replace(dc.p, billing_min_period=199901)
    fewer = {**base, "pipeline_detail": base["pipeline_detail"].where("order_header_id % 2 = 0")}
    other = spark.createDataFrame([(1,), (2,), (4,)], "order_header_id long")
    root, keys = str(tmp_path / "facts"), set()
    for how in ({}, {"cfg": later}, {"order": fewer}, {"rules": other}, {}):
        landed, plain = billed(root, **how), billed(None, **how)
        assert landed[1:] == plain[1:]
        keys.add(landed[0].fact_key)
    assert len(keys) == 4


def test_null_fanout_guard(spark):
    from revcast.plans.attribution import null_fanout

    run = driver_run(spark, SF001)
    cat = {**{n: run.order_sources[n] for n in ("reforderopp",)}, **run.crm_refs}
    got = {r.right_table: r.null_rows for r in null_fanout(cat).collect()}
    assert got["Ref_Opps"] == 2 and got["Ref_Acct"] == 0
    with pytest.raises(ValueError, match="Ref_Opps"):
        null_fanout(cat, fail=True)


def test_salt_reads_no_further_column(spark):
    """The scans of a narrow result are the same with and without salt."""
    import dataclasses
    import re

    from revcast.plans.attribution import ORDER_CHAIN, attribute_orders

    run = driver_run(spark, SF001)
    cat = {**{n: run.order_sources[n] for n in ("reforderopp",)}, **run.crm_refs}
    bare = tuple(dataclasses.replace(s, null_salt=0) if hasattr(s, "right") else s for s in ORDER_CHAIN)

    def scans(chain):
        df = attribute_orders(run.order_sources["tcv"], cat, chain).select("Amount", "Final_AcctID")
        plan = df._jdf.queryExecution().executedPlan().toString()
        return set(re.findall(r"ReadSchema: (struct<[^>\n]*)", plan))

    assert scans(ORDER_CHAIN) == scans(bare) != set()
