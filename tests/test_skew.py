"""Hot keys: the sketch that finds them and the join that splits them off."""

from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from revcast.checks.queries import QUERIES
from revcast.operators import skew
from revcast.operators.joins import JoinSpec, enrich, left_enrich
from revcast.plans.attribution import ORDER_CHAIN, PARTY_KEY, attribute_orders, hot_chain, with_party_key
from revcast.plans.pipeline import driver_run

from conftest import SF001, rows


@pytest.fixture
def shuffled(spark):
    """No broadcast by size, no adaptive execution, 16 shuffle partitions."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_profile_names_nulls_and_hot_values_of_several_keys(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 4 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("a"),
        F.when(F.col("id") < 5_000, F.lit(7)).otherwise(F.col("id")).alias("b"))
    got = skew.key_profile(df, {"a": F.col("a"), "b": F.col("b"), "none": F.col("id") if "id" in df.columns else F.col("b") * 0})
    assert got == {"a": [None, "hot"], "b": [7], "none": [0]}
    assert skew.key_profile(df.where("false"), {"a": F.col("a")}) == {"a": []}


@pytest.mark.parametrize("most", [skew.HOT_ROWS, 2])
@pytest.mark.parametrize("null_safe", [True, False])
def test_split_join_equals_the_plain_one(spark, shuffled, monkeypatch, most, null_safe):
    """Null, hot and other keys, several right rows for one of each; the few
    rows are broadcast, or (beyond the bound) copied."""
    few_rows = skew.few_rows
    monkeypatch.setattr(skew, "few_rows", lambda df: few_rows(df, most))
    left = spark.range(500).select(F.col("id"), F.when(F.col("id") % 4 == 0, None).when(F.col("id") % 4 == 1, F.lit(1))
                                   .otherwise(F.col("id")).alias("k"), F.lit("l").alias("v"))
    right = spark.createDataFrame([(None, "n1", None), (None, "n2", 2), (1, "h1", None), (1, "h2", 4), (2, "x", 5),
                                   (3, "y1", 6), (3, "y2", None), (900, "z", 8)], "k long, v string, w int")
    how = {"null_safe": null_safe}
    want = rows(left_enrich(left, right, "k", "k", **how))
    got = left_enrich(left, right, "k", "k", null_salt=8, hot_values=(1,), **how)
    assert got.columns == left_enrich(left, right, "k", "k", **how).columns
    assert rows(got) == want
    assert ("Generate" in plan(got)) == (most == 2)


def test_composite_keys_split_rows_with_any_null(spark, shuffled):
    left = spark.createDataFrame([(1, 1, None), (2, None, 3), (3, 2, 3), (4, None, None)], "id long, a long, b long")
    right = spark.createDataFrame([(1, None, "p"), (None, 3, "q"), (2, 3, "r"), (None, None, "s"), (None, None, "t")],
                                  "a long, b long, v string")
    assert rows(left_enrich(left, right, ["a", "b"], ["a", "b"], null_salt=4)) == rows(
        left_enrich(left, right, ["a", "b"], ["a", "b"]))


def test_hot_real_account_is_spread_without_copies(spark, shuffled):
    """A third of a fact has one account: the sketch finds it, and its rows pass the
    shuffle in many partitions, while no right row is copied."""
    fact = spark.range(9000).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(42)).otherwise(F.col("id")).alias("acct"))
    accounts = spark.range(9000).select(F.col("id").alias("key"), F.concat(F.lit("a"), "id").alias("name"))
    chain = (JoinSpec("acct", "acct", "key", null_salt=64, salt_on=("id",)),)
    keyed = fact.withColumn("BILL_TO_PARTY_ID", F.col("acct"))
    hot = hot_chain(keyed, {"acct": accounts}, chain, fraction=1)
    assert hot[0].hot_values == (42,)

    def most(c):
        df = enrich(fact, {"acct": accounts}, c).select("acct", "name", F.spark_partition_id().alias("p"))
        found = Counter(r.p for r in df.collect() if r.acct == 42 and r.name == "a42")
        assert sum(found.values()) == 3000
        return max(found.values())

    assert most(chain) >= 3000 and most(hot) < 600
    split = plan(enrich(fact, {"acct": accounts}, hot))
    assert "Generate" not in split and split.count("SortMergeJoin") == 1 and split.count("BroadcastHashJoin") == 1


def test_order_chain_split_equals_the_broadcast_one(spark, shuffled):
    """The whole chain, sketched and with every step shuffled, against broadcast joins."""
    run = driver_run(spark, SF001)
    cat = {**{n: run.order_sources[n] for n in ("reforderopp",)}, **run.crm_refs}
    fact = run.order_sources["tcv"]
    names = ["ORDER_HEADER_ID", "Amount", "Final_AcctID", "Acct_Name_Final", "Opps_Opportunity__c", "Offr_Offering__c"]
    hot = hot_chain(fact, cat, ORDER_CHAIN, fraction=1, share=0.01)
    assert any(s.hot_values not in ((), ("unmapped",)) for s in hot if isinstance(s, JoinSpec))
    got = attribute_orders(fact, cat, hot).select(*names)
    assert "Generate" not in plan(got)
    got = rows(got)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    assert got == rows(attribute_orders(fact, cat).select(*names))


def test_rows_are_multiplied_by_null_keys_after_the_shuffle(spark, shuffled):
    """Left rows without a key, which two right rows lack too, are shuffled once each."""
    left = spark.range(100).select(F.col("id"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"))
    right = spark.createDataFrame([(None, "a"), (None, "b"), (2, "c")], "k long, v string")
    got = left_enrich(left, right, "k", "k", null_salt=8, salt_on=("id",))
    assert got.count() == 150
    lines = [x for x in plan(got).splitlines() if "Join" in x]
    assert "BroadcastHashJoin" in lines[0] and "SortMergeJoin" in lines[1]


OPPS = ("Opps_Opportunity__c string, Opps_Month_Close__c int, Opps_Probability double, Opps_OwnerId string")


def _order_catalog(spark, bare_accounts, more_accounts=()):
    """Orders with and without opportunities, two opportunities of one number, some
    without, ones that do not exist, and accounts from each source."""
    def table(ddl, *data):
        return spark.createDataFrame(list(data), ddl)

    fact = table("PRODUCT_NUMBER_CONCAT string, BILL_TO_PARTY_ID long, PARTYNUMBER_AKA_REGISTRYID string, "
                 "Amount decimal(18,2), ORDER_HEADER_ID long",
                 *[(f"P{i % 3}" if i % 4 else None, (i % 7) or None, f"R{i % 5}" if i % 5 else None, Decimal(i), (i % 9) or None)
                   for i in range(120)])
    account = "Id string, Party_ID__c string, OwnerId string, Name string, Region__c string, Sales_Region_text__c string"
    accounts = table(account, *[(f"A{i}", str(i), f"U{i % 3}" if i % 4 else None, f"N{i}", "r", "s") for i in range(6)],
                     *more_accounts)
    prefixed = accounts.toDF(*[f"Acct_{c}" for c in accounts.columns])
    return fact, {
        "Ref_BillParty": prefixed.where("Acct_Party_ID__c in ('1', '2', '3')").withColumn(
            "Acct_Party_ID__c", F.col("Acct_Party_ID__c").cast("long")),
        "reforderopp": table("ORDER_HEADER_ID long, OPPORTUNITY_ID string, ORDER_NUMBER long",
                             (1, "O1", 11), (1, "O2", 12), (2, "O2", 13), (3, None, 14), (4, "O9", 15), (5, "O3", 16),
                             (None, "O1", 17), (None, None, 18)),
        "Ref_Opps_Acct": table("OppsAcct_Opportunity__c string, OppsAcct_Account string", ("O1", "A1"), ("O2", "A2"), ("O2", None),
                               ("O3", "A9"), *[(None, a) for a in bare_accounts]),
        "Ref_Prnt": table("Prnt_Id string, Prnt_Registry_ID__c string", ("A4", "R1"), ("A5", "R2"), ("A0", "R2"), (None, "R3")),
        "Ref_Acct": prefixed,
        "Ref_User": table("User_Id string, User_Name string", ("U0", "Uno"), ("U1", "Due"), (None, "nobody")),
        "Ref_Opps": table(OPPS, ("O1", 202001, 1.0, "U0"), ("O2", 202002, 2.0, None), ("O2", 202003, 3.0, "U1"),
                          (None, 202004, 4.0, "U1"), (None, 202005, 5.0, "U9")),
        "Ref_Offr": table("Offr_Product_Number__c string, Offr_Offering__c string", ("P1", "x"), ("P2", "y"), (None, "z"))}


@pytest.mark.parametrize("bare, twice", [((), False), (("A1", "A2"), False), (("A1", "A8"), True), ((None, None), True),
                                         (("A1", None), True)])
def test_opportunities_first_equals_the_chain(spark, shuffled, bare, twice):
    """Same rows and columns as the steps one by one; rows without an opportunity are not
    multiplied before a shuffle, and the fact is not shuffled for the opportunities."""
    more = [("A1", "1", "U1", "again", "q", "t"), ("A4", None, "U0", "also", None, None),
            ("unmapped", None, None, "none", None, None)] if twice else []
    fact, cat = _order_catalog(spark, bare, more)
    want = enrich(with_party_key(fact), cat, ORDER_CHAIN).drop(PARTY_KEY)
    got = attribute_orders(fact, cat, hot_chain(fact, cat, ORDER_CHAIN, fraction=1, share=0.2) if twice else ORDER_CHAIN)
    assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    assert rows(got) == rows(want)
    by_opportunity = "hashpartitioning(OppsAcct_Opportunity__c"
    assert by_opportunity in plan(want) and by_opportunity not in plan(got)


def test_no_salts_where_right_tables_are_small(spark):
    assert hot_chain(spark.range(5), {s.right: spark.range(1) for s in ORDER_CHAIN if isinstance(s, JoinSpec)}) is ORDER_CHAIN
    for name in ("enrichment_chain", "crm_chain"):
        assert "Generate" not in plan(QUERIES[name](spark, SF001))


def test_crm_joins_split_hot_accounts(spark, shuffled):
    """Half of the transactions have one account: the sketch names it, and the fact is
    that of the plain joins."""
    from revcast.plans import crm
    from revcast.sources.driver_tables import DriverCatalog

    objs = dict(DriverCatalog(spark, SF001).crm_objects())
    trx = objs["Fact_Trx"]
    account = trx.where("Account__c is not null").first()["Account__c"]
    objs["Fact_Trx"] = trx.withColumn("Account__c", F.when(F.crc32(F.col("Id").cast("binary")) % 2 == 0, F.lit(account))
                                      .otherwise(F.col("Account__c")))
    hot = crm.hot_transaction_keys(crm.prefixed(objs)["Fact_Trx"], 1, 0.2)
    assert hot["Trx_Account__c"] == (account,)
    split = crm.transaction_fact(objs, profile=1)
    assert "Generate" not in plan(split)
    split = rows(split)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    assert split == rows(crm.transaction_fact(objs, chain=crm.CRM_CHAIN))


@pytest.mark.parametrize("lacking", [False, True])
def test_transactions_without_a_key_go_past_its_shuffle(spark, shuffled, lacking):
    """Most rows have no project, many no milestone: they are not shuffled for them,
    unless a record lacks its id, and the fact is that of the plain joins."""
    from revcast.plans import crm
    from revcast.sources.driver_tables import DriverCatalog

    objs = dict(DriverCatalog(spark, SF001).crm_objects())
    if lacking:
        for n in ("Ref_Proj", "Ref_Mile"):
            objs[n] = objs[n].withColumn("Id", F.when(F.col("Id") != objs[n].first()["Id"], F.col("Id")))
    cat = crm.prefixed(objs)
    assert crm.bare_transaction_keys(cat["Fact_Trx"], 1) == ("Trx_Project__c", "Trx_Milestone__c")
    got = crm.transaction_fact(objs, profile=1)
    assert ("Union" in plan(got)) == (not lacking)
    assert "Trx_Id" not in plan(got) and got.columns == crm.transaction_fact(objs, chain=crm.CRM_CHAIN).columns
    got = rows(got)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    assert got == rows(crm.transaction_fact(objs, chain=crm.CRM_CHAIN))
