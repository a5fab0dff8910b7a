"""Registered queries: every operator of the inventory run on the driver
tables through the library, whole tables in, whole results out.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame whose date
columns are ISO text and whose money columns are doubles (``hashable``), so
that its values compare exactly with the SQL restatement in
``revcast.checks.oracle_sql``.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt
import os
import uuid
from collections import ChainMap
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions.fiscal import fiscal_period, fiscal_year_label
from ..functions.rules import (account_fallback, account_source, apply_overrides, hold_category,
                               inclusion_flag, milestone_type_name, override_if_key_present,
                               override_if_present, owner, pipeline_weighted_tcv, project_stage_code,
                               revenue_code, tcv_period, unweighted_tcv, weighted, weighted_tcv)
from ..functions.semantics import (exclude_drop_null, exclude_keep_null, first_non_null,
                                   product_key, trim_to_null)
from ..operators.aggregates import column_census
from ..operators.dedup import latest_per_key
from ..operators.joins import (DeriveSpec, JoinSpec, anti_join, bounded_broadcast, enrich, fanout_report,
                              left_enrich, parts_of)
from ..operators.lists import BROADCAST_VALUES, exclude_table
from ..operators.projection import move_first
from ..operators.rule_match import match_rules
from ..plans import orders as O
from ..plans.attribution import null_fanout, order_fanout
from ..plans.config import driver_config
from ..plans.crm import bill_party_ref, opportunity_account_ref
from ..plans.pipeline import ForecastRun, driver_run
from ..session import ensure_checkpoint_dir
from ..sources.driver_tables import ORDER_BASE_TABLES, DriverCatalog, load_tables, money
from ..sources.rejects import Quarantine
from ..sources.readers import load_directory, read_crm_export, read_ranges, read_sql_extracts
from ..sources.sinks import LAYERS, order_proof, read_snapshot, write_layer, write_ordered, write_snapshot

Query = Callable[[SparkSession, str], DataFrame]


# Integer columns that can hold nulls, per query: they are compared as
# doubles, because a nullable integer column turns into floats on one side
# of a pandas comparison and into nullable integers on the other.
NULLABLE_INTS = {
    "fiscal_calendar": ("fiscal_period",),
    "inclusion_flag": ("period",),
    "nullsafe_left_join": ("k",),
    "csv_roundtrip": ("customer",),
    "union_by_name": ("ORDER_HEADER_ID", "ORDER_NUMBER", "FISCAL_YYYYMM"),
    "enrichment_chain": ("BILL_TO_PARTY_ID", "ORDER_NUMBER", "FISCAL_YYYYMM", "Opps_Month_Close__c"),
    "crm_chain": ("Trx_Month", "Opp_CloseMonth"),
    "pipeline_tcv": ("Opp_CloseMonth",),
    "revenue_forecast": ("revFYFP", "Opp_CloseMonth"),
    "fact_layer_reuse": ("FISCAL_YYYYMM",),
    "tcv_forecast": ("trxFYFP", "tcvFYFP", "Opp_CloseMonth"),
}


def hashable(df: DataFrame, as_double=()) -> DataFrame:
    """Dates and timestamps as ISO text, decimals (and ``as_double``
    columns) as doubles."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in as_double:
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _tables(spark, sf_dir):
    return load_tables(spark, sf_dir)


def _lines_orders(t):
    li, o = t["lineitem"], t["orders"]
    return li.join(o, li.l_orderkey == o.o_orderkey)


_LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _run(spark, sf_dir):
    return driver_run(spark, sf_dir)


# ---------------------------------------------------------------- functions
def q_fiscal_calendar(spark, sf_dir):
    """Fiscal period and year of order dates (some null), the
    date taken through its text form."""
    o = _tables(spark, sf_dir)["orders"]
    txt = F.when(F.col("o_orderkey") % 13 == 0, F.lit(None).cast("string")) \
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    d = F.to_date(txt)
    return hashable(o.select("o_orderkey", d.alias("close_date"),
                             fiscal_period(d).alias("fiscal_period"),
                             fiscal_year_label(fiscal_period(d)).alias("fiscal_year")),
                    NULLABLE_INTS["fiscal_calendar"])


def _raw_revenue_type():
    rf, ls, ln = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_linenumber")
    return (F.when((rf == "A") & (ls == "F"), F.lit("1"))
            .when((rf == "A") & (ls == "O"), F.lit("2"))
            .when((rf == "N") & (ls == "F"), F.lit("3"))
            .when((rf == "N") & (ls == "O"), F.lit("Opportunity Schedule"))
            .when((rf == "R") & (ls == "F"), F.lit("Manual - SD"))
            .when(ln == 1, F.lit("PO Hold"))
            .when(ln == 2, F.lit(None).cast("string"))
            .otherwise(F.lit("Other")))


def _raw_stage(k):
    stages = ["Scheduled", "Unscheduled", "Soft Scheduled", "Project Initiated", "Closed",
              "Canceled", "On Hold"]
    e = None
    for i, s in enumerate(stages):
        e = F.when(k % 8 == i, F.lit(s)) if e is None else e.when(k % 8 == i, F.lit(s))
    return e


def _raw_record_type(k):
    rt = list(K.MILESTONE_RECORD_TYPES)
    return (F.when(k % 4 == 0, F.lit(rt[0])).when(k % 4 == 1, F.lit(rt[1]))
            .when(k % 4 == 2, F.lit(rt[2])).otherwise(F.lit("RT-OTHER")))


def q_code_maps(spark, sf_dir):
    """Stage, revenue, hold and milestone codes."""
    li = _tables(spark, sf_dir)["lineitem"]
    k = F.col("l_orderkey")
    stage = project_stage_code(_raw_stage(k))
    hold = hold_category(F.when(F.col("l_linenumber") % 3 == 0, F.lit("Y"))
                         .when(F.col("l_linenumber") % 3 == 1, F.lit("N")))
    x = li.select(stage.alias("stage_code"),
                  revenue_code(_raw_revenue_type(), stage).alias("revenue_code"),
                  hold.alias("hold_category"),
                  milestone_type_name(_raw_record_type(k)).alias("milestone_type"),
                  F.lit(K.SRC_ACTUAL).alias("src"), "l_quantity")
    return x.groupBy("stage_code", "revenue_code", "hold_category", "milestone_type", "src").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("qty"))


def _prob():
    k = F.col("o_orderkey")
    return F.when(k % 13 == 0, F.lit(None).cast("double")).otherwise(((k % 11) * 10).cast("double"))


def q_weighted_amounts(spark, sf_dir):
    """Probability-weighted amount for pipeline lines; the
    unweighted copy."""
    x = _lines_orders(_tables(spark, sf_dir))
    amt = F.when(F.col("l_quantity") <= 2, F.lit(None).cast("decimal(18,2)")).otherwise(money("l_extendedprice"))
    x = x.select(*_LINE_KEY, amt.alias("amount"), _prob().alias("prob"),
                 (F.col("l_linestatus") == "O").alias("pipe"))
    return hashable(x.select(*_LINE_KEY, weighted("amount", "prob", F.col("pipe")).alias("wfc"),
                             F.col("amount").alias("unwfc")))


def _line_code():
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    return (F.when((rf == "A") & (ls == "F"), F.lit("RecRev")).when((rf == "A") & (ls == "O"), F.lit("DefRev"))
            .when((rf == "N") & (ls == "F"), F.lit("BillEv")).when((rf == "N") & (ls == "O"), F.lit("PipeLn"))
            .when((rf == "R") & (ls == "F"), F.lit("Schl")).otherwise(F.lit("POH")))


def q_inclusion_flag(spark, sf_dir):
    """Forecast inclusion flag (cut-over 199812/199901), moved to
    the first column; counted per flag, code and period."""
    cfg = driver_config()
    x = _lines_orders(_tables(spark, sf_dir))
    period = F.when(F.col("l_orderkey") % 17 == 0, F.lit(None).cast("int")).otherwise(fiscal_period("l_shipdate"))
    x = x.select(period.alias("period"), _line_code().alias("code"), _prob().alias("prob"))
    x = x.withColumn("fc_filter", inclusion_flag("period", "code", "prob",
                                                 cfg.last_legacy_period, cfg.first_new_period))
    x = move_first(x, "fc_filter")
    return hashable(x.groupBy("fc_filter", "code", "period").agg(F.count(F.lit(1)).alias("n")),
                    NULLABLE_INTS["inclusion_flag"])


def q_owner_by_kind(spark, sf_dir):
    """X11: opportunity owner for pipeline lines, account owner otherwise."""
    t = _tables(spark, sf_dir)
    s = t["supplier"]
    acct_owner = s.select(F.col("s_suppkey").alias("_a"), F.col("s_name").alias("acct_owner"))
    opp_owner = s.select(F.col("s_suppkey").alias("_o"), F.col("s_name").alias("opp_owner"))
    x = _lines_orders(t)
    x = (x.join(bounded_broadcast(acct_owner), (x.o_custkey % 10) == acct_owner._a, "left")
         .join(bounded_broadcast(opp_owner), (x.o_orderkey % 10) == opp_owner._o, "left"))
    pipe = F.col("l_linestatus") == "O"
    x = x.select(owner(pipe, "opp_owner", "acct_owner").alias("owner"), pipe.alias("is_pipeline"))
    return x.groupBy("owner", "is_pipeline").agg(F.count(F.lit(1)).alias("n"))


def q_account_fallback(spark, sf_dir):
    """Account id by fallback, derived between two joins."""
    t = _tables(spark, sf_dir)
    o = t["orders"].select("o_orderkey", "o_custkey")
    c = t["customer"].select(
        F.col("c_custkey"),
        F.when(F.col("c_custkey") % 7 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("ACC"), F.col("c_custkey"))).alias("opp_account"),
        F.col("c_nationkey"))
    n = t["nation"].select("n_nationkey", "n_name")
    bill = F.when(F.col("o_orderkey") % 5 == 0, F.lit(None).cast("string")) \
        .otherwise(F.concat(F.lit("BILL"), F.col("o_custkey")))
    parent = F.when(F.col("o_orderkey") % 3 == 0, F.lit(None).cast("string")) \
        .otherwise(F.concat(F.lit("PRNT"), F.col("o_custkey") - F.col("o_custkey") % 10))
    chain = [
        JoinSpec("customer", "o_custkey", "c_custkey"),
        DeriveSpec(lambda df: df.withColumns({
            "bill_account": bill, "parent_account": parent}).withColumns({
            "acct_src": account_source("opp_account", "bill_account", "parent_account"),
            "Final_AcctID": account_fallback("opp_account", "bill_account", "parent_account")})),
        JoinSpec("nation", "c_nationkey", "n_nationkey", broadcast=True),
    ]
    out = enrich(o, {"customer": c, "nation": n}, chain)
    return out.select("o_orderkey", "Final_AcctID", "acct_src", "n_name")


def _override_inputs(spark, sf_dir):
    o = _tables(spark, sf_dir)["orders"]
    k = F.col("o_orderkey")
    return o.select(
        k,
        F.when(k % 3 == 0, F.concat(F.lit("OP-"), k + 1)).alias("line_opp"),
        F.when(k % 4 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("LINE-"), k)).alias("line_stage"),
        F.col("o_orderpriority").alias("direct_stage"),
        F.when(k % 6 == 0, F.lit(None).cast("decimal(18,2)")).otherwise((money("o_totalprice") - 100).cast("decimal(18,2)"))
         .alias("line_amount"),
        money("o_totalprice").alias("direct_amount"))


def q_override_coalesce(spark, sf_dir):
    """Milestone value when present, else the direct value."""
    x = _override_inputs(spark, sf_dir)
    return x.select("o_orderkey", override_if_present("line_stage", "direct_stage").alias("stage"),
                    override_if_present("line_opp", F.concat(F.lit("OP-"), F.col("o_orderkey"))).alias("opp"))


def q_override_gated(spark, sf_dir):
    """Milestone value whenever the line-item opportunity exists, even
    when that value is null."""
    x = _override_inputs(spark, sf_dir)
    return hashable(x.select("o_orderkey", override_if_key_present("line_opp", "line_amount", "direct_amount")
                             .alias("amount")))


def q_product_key(spark, sf_dir):
    """Product key with nulls as empty parts."""
    p = DriverCatalog(spark, sf_dir).products()
    return p.select("inventory_item_id", product_key("product_number", "format", "language").alias("product_key"))


def q_trim_id(spark, sf_dir):
    """Trimmed opportunity id (blank -> null) and its NVL."""
    oh = DriverCatalog(spark, sf_dir).order_headers()
    tid = trim_to_null("attribute11")
    return oh.select("header_id", tid.alias("opportunity_id"),
                     first_non_null(tid, F.lit("NO-OPP")).alias("opportunity_or_default"))


def q_fix_id(spark, sf_dir):
    """Single-value corrections of opportunity ids."""
    cfg = driver_config()
    oh = DriverCatalog(spark, sf_dir).order_headers()
    return oh.select("header_id", apply_overrides(trim_to_null("attribute11"), cfg.opportunity_overrides)
                     .alias("opportunity_id"))


def q_key_cast(spark, sf_dir):
    """Accounts with a party id, cast to a number."""
    acct = DriverCatalog(spark, sf_dir).crm_account()
    acct = acct.toDF(*["Acct_" + c for c in acct.columns])
    return bill_party_ref(acct).select("Acct_Id", "Acct_Party_ID__c")


def _customers_with_null_names(spark, sf_dir):
    c = _tables(spark, sf_dir)["customer"]
    name = F.when(F.col("c_custkey") % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("c_name"))
    return c.select("c_custkey", name.alias("name"))


def q_exclude_keep_null(spark, sf_dir):
    """Listed names go, null names stay."""
    cfg = driver_config()
    c = _customers_with_null_names(spark, sf_dir)
    return c.where(exclude_keep_null("name", cfg.test_accounts))


def q_exclude_drop_null(spark, sf_dir):
    """SQL NOT IN: listed names and null names go."""
    cfg = driver_config()
    c = _customers_with_null_names(spark, sf_dir)
    return c.where(exclude_drop_null("name", cfg.test_accounts))


def _mask_rules(orders):
    """Rules by customer, day and order, one in 50 orders, with each of the eight
    masks of given fields in turn; the order's key is the rule's number."""
    k = F.col("o_orderkey")
    mask = F.floor(k / 50) % 8

    def given(bit, c):
        return F.when(F.floor(mask / bit) % 2 == 1, F.col(c)).alias(c)

    return orders.where(k % 50 == 0).select(given(1, "o_custkey"), given(2, "o_orderdate"), given(4, "o_orderkey"),
                                            k.alias("number"))


def q_rule_masks(spark, sf_dir):
    """Rules with open fields; of those that fit an order the most
    special mask and its least number."""
    o = _tables(spark, sf_dir)["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    fields = {c: c for c in ("o_custkey", "o_orderdate", "o_orderkey")}
    made = match_rules(o, _mask_rules(o), fields, value="number")
    return made.select("o_orderkey", "rule_mask", F.col("rule_value").alias("number"))


def q_exclude_table(spark, sf_dir):
    """exclusion lists in a table, with and without nulls on both sides,
    in both null regimes, by broadcast and behind a Bloom filter."""
    o = _tables(spark, sf_dir)["orders"]
    k = F.col("o_orderkey")
    rows = o.select(k, F.when(k % 10 != 0, F.col("o_custkey")).alias("customer"))
    some = o.where(k % 3 == 0).select(F.col("o_custkey").alias("customer"))
    null = o.where(k % 3 == 0).select(F.when(k % 6 != 0, F.col("o_custkey")).alias("customer"))
    out = None
    for name, listed, keep in (("keep", some, True), ("keep, null listed", null, True), ("drop", some, False),
                               ("drop, null listed", null, False)):
        for how, most in (("broadcast", BROADCAST_VALUES), ("bloom", 0)):
            one = exclude_table(rows, "customer", listed, keep_null=keep, broadcast_values=most).select(
                F.lit(name).alias("regime"), F.lit(how).alias("how"), "o_orderkey", F.col("customer").cast("double").alias("customer"))
            out = one if out is None else out.unionByName(one)
    return out


def q_include_list(spark, sf_dir):
    """transactions of the listed types, per type and month."""
    tx = DriverCatalog(spark, sf_dir).transactions()
    x = tx.where(F.col("Transaction_Type__c").isin(*K.CRM_TRANSACTION_TYPES))
    return hashable(x.groupBy("Transaction_Type__c", "Transaction_Month__c").agg(
        F.count(F.lit(1)).alias("n"), F.sum("Transaction_Amount__c").alias("amount")))


def q_period_range(spark, sf_dir):
    """lines per fiscal period inside a two-sided range."""
    cfg = driver_config()
    li = _tables(spark, sf_dir)["lineitem"]
    p = fiscal_period("l_shipdate")
    x = li.select(p.alias("period")).where(F.col("period").between(cfg.ledger_min_period, cfg.ledger_max_period))
    return x.groupBy("period").agg(F.count(F.lit(1)).alias("n"))


def q_prefix_match(spark, sf_dir):
    """headers whose transaction number is present and does not
    start with the pro-forma prefix; groups whose name starts with 'CL'."""
    dc = DriverCatalog(spark, sf_dir)
    ph = dc.pipeline_headers().where(F.col("transaction_no").isNotNull()
                                     & ~F.col("transaction_no").startswith(K.PRO_FORMA_PREFIX))
    rg = dc.rep_groups().where(F.col("group_name").startswith(K.REP_GROUP_PREFIX))
    a = ph.groupBy("pipeline_source").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("header").alias("kind"), F.col("pipeline_source").alias("code"), "n")
    b = rg.select(F.lit("group").alias("kind"), F.col("group_id").cast("string").alias("code"),
                  F.lit(1).cast("long").alias("n"))
    return a.unionByName(b)


def q_segment_eq(spark, sf_dir):
    """F8: ledger lines of one segment pair, per code combination."""
    dc = DriverCatalog(spark, sf_dir)
    cc = dc.gl_code_combos().where((F.col("segment1") == K.LEDGER_SEGMENT1) & (F.col("segment2") == K.LEDGER_SEGMENT2))
    sd = dc.sales_detail()
    x = sd.join(bounded_broadcast(cc), "code_combination_id")
    return hashable(x.groupBy("code_combination_id", "segment1", "segment2").agg(
        F.count(F.lit(1)).alias("n"), F.sum("line_amount").alias("amount")))


# ---------------------------------------------------------------- joins
def q_effective_dated_reps(spark, sf_dir):
    """C2 (F11, J11, J12, W1, X15, X16, X18): order -> opportunity and rep."""
    run = _run(spark, sf_dir)
    return O.order_opportunity_map(run.order_base, run.cfg)


def q_nullsafe_left_join(spark, sf_dir):
    """Left join where a null key matches the one null right key."""
    t = _tables(spark, sf_dir)
    o = t["orders"].select("o_orderkey", F.when(F.col("o_orderkey") % 13 == 0, F.lit(None).cast("long"))
                           .otherwise(F.col("o_custkey")).alias("k"))
    c = t["customer"].select(F.when(F.col("c_custkey") == 5, F.lit(None).cast("long"))
                             .otherwise(F.col("c_custkey")).alias("key"), "c_name")
    return hashable(left_enrich(o, c, "k", "key").select("o_orderkey", "k", "c_name"),
                    NULLABLE_INTS["nullsafe_left_join"])


def q_composite_key_join(spark, sf_dir):
    """Lines joined to headers on (header id, source)."""
    dc = DriverCatalog(spark, sf_dir)
    pd_ = dc.pipeline_detail()
    ph = dc.pipeline_headers()
    # A task sorts and groups a bounded number of lines, whatever their number is in all.
    keys = ["pipeline_header_id", "pipeline_source"]
    parts = parts_of(dc.t["lineitem"])
    x = pd_.repartition(parts, *keys).join(ph.repartition(parts, *keys), keys, "left")
    return hashable(x.groupBy("pipeline_header_id", "pipeline_source", "transaction_no").agg(
        F.count(F.lit(1)).alias("n"), F.sum("future_billing_amount").alias("amount")))


def q_fanout_report(spark, sf_dir):
    """Order keys at which joining lines to orders multiplies rows."""
    t = _tables(spark, sf_dir)
    return fanout_report(t["orders"], t["lineitem"], "o_orderkey", "l_orderkey")


def q_unreported_opps(spark, sf_dir):
    """Opportunities whose number no open line reports (a
    reported null number hides the opportunity with a null number)."""
    dc = DriverCatalog(spark, sf_dir)
    opps = dc.crm_opportunity().toDF(*["Opps_" + c for c in dc.crm_opportunity().columns])
    li = dc.t["lineitem"].where(F.col("l_linestatus") == "O")
    reported = li.select(F.when(F.col("l_orderkey") % 13 == 0, F.lit(None).cast("string"))
                         .otherwise(F.concat(F.lit("OP-"), F.col("l_orderkey"))).alias("Opp_Num"))
    out = anti_join(opps, reported, "Opps_Opportunity__c", "Opp_Num")
    return hashable(out.select("Opps_Id", "Opps_Opportunity__c", "Opps_StageName", "Opps_Amount"))


# ---------------------------------------------------------------- extracts
def q_billing_fact(spark, sf_dir):
    """A1 (J5): billing-events extract."""
    run = _run(spark, sf_dir)
    return hashable(O.billing_events_fact(run.order_base, run.cfg))


def q_recognised_deferred(spark, sf_dir):
    """A2, X12 (J5): recognised / deferred revenue extract."""
    run = _run(spark, sf_dir)
    return hashable(O.recognised_deferred_fact(run.order_base, run.cfg))


def q_contracted_tcv(spark, sf_dir):
    """A3, X13, J6 (J5): contracted TCV extract with zero-out rules."""
    run = _run(spark, sf_dir)
    return hashable(O.contracted_tcv_fact(run.order_base, run.cfg, run.party_date_rules, run.order_rules))


def q_po_hold_fact(spark, sf_dir):
    """Purchase-order hold extract."""
    run = _run(spark, sf_dir)
    return hashable(O.po_hold_fact(run.order_base, run.cfg))



def q_union_by_name(spark, sf_dir):
    """Billing, ledger and hold rows by column name."""
    return hashable(_run(spark, sf_dir).order_sources["revfact"], NULLABLE_INTS["union_by_name"])


def q_crm_chain(spark, sf_dir):
    """CRM transaction fact."""
    return hashable(_run(spark, sf_dir).fact_trx, NULLABLE_INTS["crm_chain"])


def q_pipeline_tcv(spark, sf_dir):
    """Pipeline TCV per opportunity and offering, computed here
    from the CRM transaction fact of the fact layer (the fact is read twice:
    for the pipeline sums and for the opportunity attributes)."""
    from ..plans.crm import pipeline_tcv

    fact = driver_run(spark, sf_dir, facts=True).fact_trx
    return hashable(pipeline_tcv(fact), NULLABLE_INTS["pipeline_tcv"])


def q_latest_offering(spark, sf_dir):
    """Latest offering per product number."""
    return _run(spark, sf_dir).crm_refs["Ref_Offr"]


def q_nested_parent(spark, sf_dir):
    """Opportunity -> account id from the nested parent record."""
    return opportunity_account_ref(DriverCatalog(spark, sf_dir).crm_opportunity_account())


ENRICHED_COLUMNS = (
    "PRODUCT_NUMBER_CONCAT", "BILL_TO_PARTY_ID", "FISCAL_YYYYMM", "Amount", "ORDER_HEADER_ID",
    "Acct_Id_Bill2map", "OPPORTUNITY_ID", "ORDER_NUMBER", "OppsAcct_Opportunity__c",
    "OppsAcct_Account", "Prnt_Id", "acct_src", "Final_AcctID", "Acct_Id_Final", "Acct_Name_Final",
    "Acct_Sales_Region_text__c_Final", "User_Name_x", "Opps_Opportunity__c", "Opps_Month_Close__c",
    "Opps_Probability", "Opps_Amount", "Offr_Offering__c", "User_Name_Opps",
)


def q_enrichment_chain(spark, sf_dir):
    """The ten-step enrichment of the TCV extract."""
    df = _run(spark, sf_dir).fact_layer["tcv_attributed"]
    return hashable(df.select(*[F.col(f"`{c}`") for c in ENRICHED_COLUMNS]), NULLABLE_INTS["enrichment_chain"])


def q_column_census(spark, sf_dir):
    """Value kinds per column of the events table."""
    return column_census(_tables(spark, sf_dir)["events"])


def q_fact_census(spark, sf_dir):
    """A6 on the combined order revenue fact (billing, ledger and hold rows),
    the table the original took its census of."""
    return column_census(_run(spark, sf_dir).order_sources["revfact"])


def q_tcv_dates_amounts(spark, sf_dir):
    """TCV period and amounts by source kind."""
    x = _lines_orders(_tables(spark, sf_dir))
    src = (F.when(F.col("l_returnflag") == "A", F.lit(K.SRC_ACTUAL))
           .when(F.col("l_returnflag") == "N", F.lit(K.SRC_PIPELINE)).otherwise(F.lit(K.SRC_UNREPORTED)))
    x = x.select(*_LINE_KEY, src.alias("src"), fiscal_period("l_shipdate").alias("trx"),
                 fiscal_period("o_orderdate").alias("close"), money("l_extendedprice").alias("actual"),
                 money("o_totalprice").alias("pipe_amt"), _prob().alias("prob"))
    x = x.withColumn("unw", unweighted_tcv("src", "actual", "pipe_amt"))
    return x.select(*_LINE_KEY, "src", tcv_period("src", "trx", "close").alias("tcvFYFP"), "unw",
                    weighted_tcv("src", "unw", "prob").alias("w"),
                    pipeline_weighted_tcv("src", "unw", "prob").alias("w_pl"))


def q_revenue_forecast(spark, sf_dir):
    """The revenue forecast, from the fact layer (the enriched facts
    are written once per input and code version, then read back)."""
    return hashable(driver_run(spark, sf_dir, facts=True).fcrev, NULLABLE_INTS["revenue_forecast"])


def q_tcv_forecast(spark, sf_dir):
    """The TCV forecast, from the fact layer."""
    return hashable(driver_run(spark, sf_dir, facts=True).fctcv, NULLABLE_INTS["tcv_forecast"])


def q_snapshot_roundtrip(spark, sf_dir):
    """A dated snapshot written under the checkpoint folder,
    then read back (partition-pruned) through the directory loader."""
    root = os.path.join(ensure_checkpoint_dir(spark), "snapshots", uuid.uuid4().hex)
    o = _tables(spark, sf_dir)["orders"]
    df = o.select("o_orderkey", "o_custkey", money("o_totalprice").alias("amount"),
                  fiscal_period("o_orderdate").alias("period"))
    write_snapshot(df, os.path.join(root, "orders_fc"), _dt.date(1999, 6, 30), sort_cols=("o_orderkey",))
    loaded = load_directory(spark, root)["orders_fc"]
    back = read_snapshot(spark, os.path.join(root, "orders_fc"), "1999-06-30")
    assert set(loaded.columns) == set(back.columns)
    return hashable(back)


def _scratch(spark, what: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), what, uuid.uuid4().hex)


def q_latest_offering_ts(spark, sf_dir):
    """W2 on timestamps: the latest event of each user."""
    return latest_per_key(_tables(spark, sf_dir)["events"], "user_id", "ts", ["event_type"])


def q_csv_roundtrip(spark, sf_dir):
    """Rows with doubled quotes, separators, line breaks, accents and
    missing numbers, written as CSV and read by the directory loader."""
    root, k = _scratch(spark, "csv"), F.col("o_orderkey")
    text = F.concat(F.lit('a "'), "o_orderpriority", F.lit('", b\né,'), k.cast("string"))
    df = _tables(spark, sf_dir)["orders"].select(
        k.alias("order_id"), F.when(k % 5 != 0, text).alias("note"),
        F.when(k % 3 != 0, F.col("o_custkey").cast("double")).alias("customer"),
        F.to_date("o_orderdate").alias("day"), money("o_totalprice").alias("amount"), F.lit("last").alias("tail"))
    df.write.csv(f"{root}/orders_csv", header=True, quote='"', escape='"', encoding="ISO-8859-1")
    schema = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("customer", T.LongType()),
                           T.StructField("day", T.DateType()), T.StructField("amount", T.DecimalType(18, 2))])
    return hashable(load_directory(spark, root, {"orders_csv": schema}, fmt="csv")["orders_csv"],
                    NULLABLE_INTS["csv_roundtrip"])


def q_fact_layer_rerun(spark, sf_dir):
    """A second run with another parameter under one fact root reads its
    own tables, not those of the first run."""
    dc, root = DriverCatalog(spark, sf_dir), _scratch(spark, "rerun")
    base = {n: getattr(dc, n)() for n in ORDER_BASE_TABLES}

    def billed(cfg):
        return ForecastRun(base, {}, cfg, dc.zero_party_date_rules(), dc.zero_order_rules(), root).order_sources["billev"]

    billed(driver_config())
    again = billed(dataclasses.replace(driver_config(), billing_min_period=199901))
    return hashable(again.groupBy("FISCAL_YYYYMM").agg(F.count(F.lit(1)).alias("n"), F.sum("Amount").alias("amount")))


def q_fact_layer_reuse(spark, sf_dir):
    """A second run with the same inputs, on frames read anew, opens the
    tables of the first; ``copies`` counts what the catalogue holds of them."""
    root = _scratch(spark, "reuse")

    def run():
        dc = DriverCatalog(spark, sf_dir)
        return ForecastRun({n: getattr(dc, n)() for n in ORDER_BASE_TABLES}, {}, driver_config(),
                           dc.zero_party_date_rules(), dc.zero_order_rules(), root)

    first, second = run(), run()
    names = ("billev", "tcv")
    for one in (first, second):
        made = [one.order_sources[n] for n in names]
    copies = [len(first.catalogue.manifests(first.fact_key, "order_sources", n)) for n in names]
    out = None
    for name, df, k in zip(names, made, copies, strict=True):
        one = df.groupBy("FISCAL_YYYYMM").agg(F.count(F.lit(1)).alias("n"), F.sum("Amount").alias("amount")).select(
            F.lit(name).alias("extract"), "FISCAL_YYYYMM", "n", "amount", F.lit(k).cast("long").alias("copies"),
            F.lit(first.fact_key == second.fact_key).alias("same_key"))
        out = one if out is None else out.unionByName(one)
    return hashable(out, NULLABLE_INTS["fact_layer_reuse"])


def q_crm_json_export(spark, sf_dir):
    """Account records as JSON lines with their attributes record,
    read as a CRM export with its prefix."""
    root, acct = _scratch(spark, "json"), DriverCatalog(spark, sf_dir).crm_account()
    acct.withColumn("attributes", F.struct(F.lit("Account").alias("type"))).write.json(root)
    schema = T.StructType([T.StructField("attributes", T.StructType([T.StructField("type", T.StringType())])),
                           *acct.schema.fields])
    return read_crm_export(spark, root, schema, prefix=K.CRM_PREFIXES["Ref_Acct"])


def q_reject_report(spark, sf_dir):
    """Orders as JSON lines and as CSV, with lines cut short (one in 13)
    and amounts that are none (one in 17): what the readers kept and what went to
    the quarantine, each counted on its own."""
    root, k = _scratch(spark, "rejects"), F.col("o_orderkey")
    o = _tables(spark, sf_dir)["orders"].select("o_orderkey", "o_custkey", money("o_totalprice").alias("amount"))
    line = F.to_json(F.struct(*o.columns))
    o.select(F.when(k % 13 == 0, F.substring(line, 1, 12)).otherwise(line)).write.text(f"{root}/json")
    o.withColumn("amount", F.when(k % 17 == 0, F.lit("n/a")).otherwise(F.col("amount").cast("string"))) \
        .withColumn("note", F.lit("two\nlines")).write.csv(f"{root}/csv/orders_csv", header=True, quote='"', escape='"')
    q = Quarantine(spark, f"{root}/quarantine")
    kept = {"orders_json": read_crm_export(spark, f"{root}/json", o.schema, on_reject="quarantine", quarantine=q,
                                           source="orders_json"),
            **load_directory(spark, f"{root}/csv", {"orders_csv": o.schema}, fmt="csv", on_reject="quarantine", quarantine=q)}
    sums = None
    for source, df in kept.items():
        one = df.agg(F.sum("amount").alias("amount")).select(F.lit(source).alias("source"), "amount")
        sums = one if sums is None else sums.unionByName(one)
    reasons = q.rows().groupBy("source").agg(F.max("reason").alias("reason"))
    return hashable(q.report().join(sums, "source").join(reasons, "source"))


def q_layer_roundtrip(spark, sf_dir):
    """One table written to each output layer and read back."""
    root = _scratch(spark, "layers")
    df = _tables(spark, sf_dir)["orders"].select("o_orderkey", money("o_totalprice").alias("amount"))
    out = None
    for layer in LAYERS:
        path = write_layer({"orders": df}, root, layer)["orders"]
        back = spark.read.parquet(path).select(F.lit(layer).alias("layer"), "o_orderkey", "amount")
        out = back if out is None else out.unionByName(back)
    return hashable(out)


def q_view_extract(spark, sf_dir):
    """S1, P1 over registered views: SQL text and a strict projection."""
    _tables(spark, sf_dir)["orders"].createOrReplaceTempView("extract_orders")
    sql = """SELECT o_orderstatus AS status, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS amount,
                    max(o_orderkey) AS unused FROM extract_orders GROUP BY o_orderstatus"""
    made = read_sql_extracts(spark, {"by_status": {"sql": sql, "finalcols": ["status", "n", "amount"]}})
    return hashable(made["by_status"])


def q_extract_ranges(spark, sf_dir):
    """An extract over a view cut into ranges of its partition column by
    quantiles, nulls apart; in how many ranges each row is, and whether none but the
    nulls' has over twice its share."""
    k = F.col("o_orderkey")
    _tables(spark, sf_dir)["orders"].select(k, F.when(k % 9 != 0, F.col("o_custkey") * F.col("o_custkey")).alias("cust")) \
        .createOrReplaceTempView("ranged_orders")
    df = read_sql_extracts(spark, {"o": {"sql": "SELECT * FROM ranged_orders"}})["o"]
    ranges = read_ranges(df, "cust", 8)
    rows = reduce(DataFrame.unionByName, [r.withColumn("range", F.lit(i)) for i, r in enumerate(ranges)])
    sizes = rows.where("range > 0").groupBy("range").agg(F.count(F.lit(1)).alias("n")).agg(
        (F.max("n") <= 2 * F.sum("n") / (len(ranges) - 1)).alias("balanced")).first()
    return rows.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("ranges")).withColumn("balanced", F.lit(sizes.balanced))


def q_ordered_sink(spark, sf_dir):
    """O1: a table written in a total order (from the greatest customer down, then by
    order); ``in_order`` says of each row that its part file is sorted and does not
    begin before the file before it ends."""
    o = _tables(spark, sf_dir)["orders"].select("o_orderkey", "o_custkey")
    cols = ["-o_custkey", "o_orderkey"]
    path = write_ordered(o, os.path.join(_scratch(spark, "ordered"), "orders"), cols)
    back = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("file"))
    proof = order_proof(spark, path, cols).select("file", (F.col("in_file") & F.col("after")).alias("in_order"))
    return back.join(proof, "file").select("o_orderkey", "o_custkey", "in_order")


def q_null_fanout(spark, sf_dir):
    """How often each step of the order chain multiplies rows with
    a null key."""
    run = _run(spark, sf_dir)
    return null_fanout(ChainMap(run.order_sources, run.crm_refs))


def q_fanout_forecast(spark, sf_dir):
    """Rows that each join of the order chain makes of the contracted
    value extract, forecast from its keys alone."""
    run = _run(spark, sf_dir)
    return order_fanout(run.order_sources["tcv"], ChainMap(run.order_sources, run.crm_refs))


QUERIES: dict[str, Query] = {
    "fanout_forecast": q_fanout_forecast,
    "latest_offering_ts": q_latest_offering_ts,
    "csv_roundtrip": q_csv_roundtrip,
    "fact_layer_rerun": q_fact_layer_rerun,
    "fact_layer_reuse": q_fact_layer_reuse,
    "crm_json_export": q_crm_json_export,
    "reject_report": q_reject_report,
    "layer_roundtrip": q_layer_roundtrip,
    "view_extract": q_view_extract,
    "ordered_sink": q_ordered_sink,
    "extract_ranges": q_extract_ranges,
    "null_fanout": q_null_fanout,
    "fiscal_calendar": q_fiscal_calendar,
    "code_maps": q_code_maps,
    "weighted_amounts": q_weighted_amounts,
    "inclusion_flag": q_inclusion_flag,
    "owner_by_kind": q_owner_by_kind,
    "account_fallback": q_account_fallback,
    "override_coalesce": q_override_coalesce,
    "override_gated": q_override_gated,
    "product_key": q_product_key,
    "trim_id": q_trim_id,
    "fix_id": q_fix_id,
    "key_cast": q_key_cast,
    "exclude_keep_null": q_exclude_keep_null,
    "exclude_drop_null": q_exclude_drop_null,
    "rule_masks": q_rule_masks,
    "exclude_table": q_exclude_table,
    "include_list": q_include_list,
    "period_range": q_period_range,
    "prefix_match": q_prefix_match,
    "segment_eq": q_segment_eq,
    "effective_dated_reps": q_effective_dated_reps,
    "nullsafe_left_join": q_nullsafe_left_join,
    "composite_key_join": q_composite_key_join,
    "fanout_report": q_fanout_report,
    "unreported_opps": q_unreported_opps,
    "billing_fact": q_billing_fact,
    "recognised_deferred": q_recognised_deferred,
    "contracted_tcv": q_contracted_tcv,
    "po_hold_fact": q_po_hold_fact,
    "union_by_name": q_union_by_name,
    "crm_chain": q_crm_chain,
    "pipeline_tcv": q_pipeline_tcv,
    "latest_offering": q_latest_offering,
    "nested_parent": q_nested_parent,
    "enrichment_chain": q_enrichment_chain,
    "column_census": q_column_census,
    "fact_census": q_fact_census,
    "tcv_dates_amounts": q_tcv_dates_amounts,
    "revenue_forecast": q_revenue_forecast,
    "tcv_forecast": q_tcv_forecast,
    "snapshot_roundtrip": q_snapshot_roundtrip,
}
