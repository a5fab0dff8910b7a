"""Role mapping: the driver's star-schema tables as forecast sources.

The forecast pipelines read order-system base tables and CRM objects. The
test and benchmark data are TPC-H-like tables instead, so this module
derives every source the pipelines need from them, in Spark, so that the
work grows with the data:

* transaction line  = lineitem (joined to its order for the customer)
* order header, opportunity, project, milestone = orders
* account, party    = customer;  owner, rep, resource = supplier
* product, offering = part;      region = nation -> region
* pipeline source   = l_returnflag (A: billing, N: open, R: closed)

Nulls, blanks, duplicates and non-matching keys are made by arithmetic on
the keys, so that every null rule of the pipelines is exercised. The same
mapping is restated in SQL for the DuckDB oracle (``revcast.checks``).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.fiscal import fiscal_period
from ..functions.semantics import product_key
from ..operators.sizes import bounded_broadcast, sized_join
from ..plans._lazy import LazyMap
from ..plans.config import (DRIVER_ZERO_ORDERS, DRIVER_ZERO_PARTY_DATES, ForecastConfig,
                            driver_config)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Order-system base tables derived by ``DriverCatalog`` (method names).
ORDER_BASE_TABLES = (
    "pipeline_detail", "sales_detail", "dim_dates", "products", "pipeline_sources", "parties",
    "customers_bill_to", "customers_sold_to", "pipeline_order_lines", "pipeline_resources",
    "pipeline_headers", "gl_code_combos", "salesreps", "order_headers", "rep_groups", "group_members",
    "reps", "people", "order_lines", "item_master", "cust_accounts", "acct_sites", "site_uses",
    "order_holds", "hold_sources", "hold_definitions")


def load_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> Mapping[str, DataFrame]:
    """The driver parquet tables, each opened (its footer is read) on first use."""
    return LazyMap({n: lambda n=n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names})


def money(c) -> Column:
    return (c if isinstance(c, Column) else F.col(c)).cast("decimal(18,2)")


def day_key(ts) -> Column:
    d = F.to_date(ts if isinstance(ts, Column) else F.col(ts))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("long")


def _s(*parts) -> Column:
    """Concatenate literals and columns (all non-null) as text."""
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _mod(c: str, n: int) -> Column:
    return F.col(c) % n


def _line_id() -> Column:
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def _format(partkey: Column, ptype: Column) -> Column:
    return F.when(partkey % 17 == 0, F.lit(None).cast("string")).otherwise(ptype)


def _language(size: Column) -> Column:
    return F.when(size % 3 == 0, F.lit("EN")).when(size % 3 == 1, F.lit("DE"))


def _memo(fn):
    """Build a derived table once per catalog, so that every use of it in a
    plan is the same subtree and Spark reuses its exchanges."""
    name = fn.__name__

    def wrapper(self):
        cache = self.__dict__.setdefault("_memo", {})
        if name not in cache:
            cache[name] = fn(self)
        return cache[name]

    wrapper.__name__ = name
    wrapper.__doc__ = fn.__doc__
    return wrapper


class DriverCatalog:
    """Builds the forecast sources from the driver tables on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str, config: ForecastConfig | None = None):
        self.spark = spark
        self.t = load_tables(spark, sf_dir)
        self.p = config or driver_config()

    # -- shared bases -------------------------------------------------------
    @_memo
    def order_lines_joined(self) -> DataFrame:
        """Lines with their order's customer (shuffle join on order key). Day and price are
        made before it: they take fewer bytes than a time and a double."""
        li = self.t["lineitem"].withColumns({"_day": F.to_date("l_shipdate"), "_price": money("l_extendedprice")})
        o = self.t["orders"].select("o_orderkey", "o_custkey")
        return sized_join(li, o, li.l_orderkey == o.o_orderkey, "inner")

    @_memo
    def transactions(self) -> DataFrame:
        """All CRM transaction records (every type): lines + order + part."""
        p = self.t["part"].select("p_partkey", "p_brand", "p_type", "p_size", "p_name")
        x = sized_join(self.order_lines_joined(), p, F.col("l_partkey") == F.col("p_partkey"), "inner")
        amount = (F.when(F.col("l_quantity") <= 2, F.lit(None).cast("decimal(18,2)"))
                  .when(F.col("l_quantity") == 3, F.lit(0).cast("decimal(18,2)"))
                  .otherwise(F.col("_price")))
        flag_r = F.col("l_returnflag") == "R"
        return x.select(
            F.lit(self.p.as_of_date).alias("Today__c"),
            _s("TX", F.col("l_orderkey"), "-", F.col("l_linenumber"), "-",
               F.col("l_partkey"), "-", F.col("l_suppkey")).alias("Id"),
            (F.col("l_orderkey") + 1000000).cast("string").alias("Order_Number__c"),
            F.trunc("_day", "month").alias("Transaction_Month__c"),
            F.when(F.col("l_linestatus") == "O", F.lit("Opportunity Schedule"))
             .when(flag_r, F.lit("Manual - SD")).otherwise(F.lit("Invoice"))
             .alias("Transaction_Type__c"),
            F.when(_mod("o_custkey", 10) == 9, F.lit(None).cast("string"))
             .otherwise(_s("ACC", F.col("o_custkey"))).alias("Account__c"),
            product_key(F.col("p_brand"), _format(F.col("p_partkey"), F.col("p_type")),
                        _language(F.col("p_size"))).alias("Product_Number__c"),
            F.when(_mod("p_partkey", 23) == 0, F.lit(None).cast("string"))
             .otherwise(F.col("p_name")).alias("Offering__c"),
            _s("Item ", F.col("l_partkey")).alias("Product__c"),
            _s("OPP", F.col("l_orderkey")).alias("Opportunity__c"),
            amount.alias("Transaction_Amount__c"),
            F.when(flag_r, _s("PRJ", F.col("l_orderkey"))).alias("Project__c"),
            F.when(flag_r, F.lit("Y")).otherwise(F.lit("N")).alias("Project_Flag__c"),
            F.when(flag_r | (_mod("l_orderkey", 3) == 0), _s("MS", F.col("l_orderkey")))
             .alias("Milestone__c"),
        )

    # -- order-system base tables ------------------------------------------
    @_memo
    def pipeline_detail(self) -> DataFrame:
        x = self.order_lines_joined()
        return x.select(
            F.col("l_orderkey").alias("order_header_id"),
            _line_id().alias("order_line_id"),
            F.col("l_orderkey").alias("pipeline_header_id"),
            F.col("l_returnflag").alias("pipeline_source"),
            day_key("_day").alias("transaction_date_key"),
            F.col("l_partkey").alias("inventory_item_id"),
            F.col("o_custkey").alias("bill_to_party_id"),
            F.col("o_custkey").alias("bill_to_customer_id"),
            F.col("o_custkey").alias("sold_to_customer_id"),
            F.col("l_suppkey").alias("resource_id"),
            F.col("_price").alias("future_billing_amount"),
            self._status_amount("O").alias("open_order_amount"),
            self._status_amount("F").alias("closed_order_amount"),
        )

    @staticmethod
    def _status_amount(status: str) -> Column:
        """Order value when the line has ``status``, else 0; unknown (null)
        for the smallest lines, so null sums still occur."""
        return (F.when(F.col("l_quantity") <= 2, F.lit(None).cast("decimal(18,2)"))
                .when(F.col("l_linestatus") == status, F.col("_price"))
                .otherwise(F.lit(0).cast("decimal(18,2)")))

    @_memo
    def sales_detail(self) -> DataFrame:
        x = self.order_lines_joined()
        return x.select(
            F.col("l_orderkey").alias("order_header_id"),
            (F.col("l_suppkey") % 4).alias("code_combination_id"),
            day_key("_day").alias("gl_date_key"),
            F.col("l_partkey").alias("inventory_item_id"),
            F.col("o_custkey").alias("bill_to_party_id"),
            F.col("o_custkey").alias("bill_to_customer_id"),
            F.col("o_custkey").alias("sold_to_customer_id"),
            F.col("l_suppkey").alias("salesrep_id"),
            F.col("_price").alias("line_amount"),
        )

    @_memo
    def line_codes(self) -> DataFrame:
        """Distinct (day, return flag, ledger code, hold code) of the lines:
        one scan and one small aggregate shared by every code dimension
        below (bounded: days x 3 x 4 x 3 rows)."""
        li = self.t["lineitem"]
        return li.select(F.to_date("l_shipdate").alias("date_field"), "l_returnflag",
                         (F.col("l_suppkey") % 4).alias("code_combination_id"),
                         ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) % 3).alias("hold_code")).distinct()

    @_memo
    def dim_dates(self) -> DataFrame:
        d = self.line_codes().select("date_field").distinct()
        return d.select(day_key(F.col("date_field")).alias("date_key"), "date_field",
                        fiscal_period(F.col("date_field")).alias("fiscal_yyyymm"))

    @_memo
    def products(self) -> DataFrame:
        p = self.t["part"]
        return p.select(
            F.col("p_partkey").alias("inventory_item_id"),
            F.col("p_brand").alias("product_number"),
            _format(F.col("p_partkey"), F.col("p_type")).alias("format"),
            _language(F.col("p_size")).alias("language"),
            F.col("p_name").alias("title_abbreviation"),
        )

    @_memo
    def pipeline_sources(self) -> DataFrame:
        f = F.col("pipeline_source")
        return (self.line_codes().select(F.col("l_returnflag").alias("pipeline_source")).distinct()
                .withColumn("description",
                            F.when(f == "A", F.lit(K.BILLING_SOURCES[0]))
                             .when(f == "N", F.lit(K.CONTRACT_SOURCES[0]))
                             .when(f == "R", F.lit(K.CONTRACT_SOURCES[1]))))

    @_memo
    def parties(self) -> DataFrame:
        c = self.t["customer"]
        return c.select(F.col("c_custkey").alias("party_id"), F.col("c_name").alias("party_name"),
                        _s("RG", F.col("c_custkey")).alias("party_number"))

    @_memo
    def customers_bill_to(self) -> DataFrame:
        c = self.t["customer"]
        parent = F.col("c_custkey") - F.col("c_custkey") % 10
        return c.select(F.col("c_custkey").alias("cust_account_id"),
                        F.col("c_name").alias("account_name"),
                        _s("AC", F.col("c_custkey")).alias("account_number"),
                        _s("RG", parent).alias("parent_number"),
                        _s("Parent ", parent).alias("parent_name"))

    @_memo
    def customers_sold_to(self) -> DataFrame:
        c = self.t["customer"]
        return c.select(F.col("c_custkey").alias("cust_account_id"),
                        F.col("c_name").alias("account_name"),
                        _s("AC", F.col("c_custkey")).alias("account_number"))

    @_memo
    def pipeline_order_lines(self) -> DataFrame:
        ids = self.t["lineitem"].select(_line_id().alias("order_line_id")).distinct()
        k = F.col("order_line_id")
        rule = (F.when(k % 7 == 0, F.lit(K.BILLING_EXCLUDED_ACCOUNTING_RULES[0]))
                .when(k % 7 == 1, F.lit(K.BILLING_EXCLUDED_ACCOUNTING_RULES[1]))
                .when(k % 7 == 2, F.lit(None).cast("string"))
                .otherwise(F.lit("Standard")))
        hold = (F.when(k % 5 == 0, F.lit(None).cast("string"))
                .when(k % 5 == 1, F.lit("N")).otherwise(F.lit(K.HOLD_FLAG)))
        return ids.select(k, rule.alias("accounting_rule"), hold.alias("po_hold"))

    @_memo
    def pipeline_resources(self) -> DataFrame:
        s = self.t["supplier"]
        return s.select(F.col("s_suppkey").alias("resource_id"), F.col("s_name").alias("resource_name"))

    @_memo
    def pipeline_headers(self) -> DataFrame:
        h = (self.t["lineitem"].select(F.col("l_orderkey").alias("pipeline_header_id"),
                                       F.col("l_returnflag").alias("pipeline_source")).distinct())
        k = F.col("pipeline_header_id")
        tno = (F.when(k % 9 == 0, _s(K.PRO_FORMA_PREFIX, k))
               .when(k % 9 == 1, F.lit(None).cast("string"))
               .otherwise(_s("T", k)))
        return h.withColumn("transaction_no", tno)

    @_memo
    def gl_code_combos(self) -> DataFrame:
        ids = self.line_codes().select("code_combination_id").distinct()
        k = F.col("code_combination_id")
        s1 = F.when(k < 2, F.lit(K.LEDGER_SEGMENT1)).otherwise(F.lit("02"))
        s2 = F.when(k % 2 == 0, F.lit(K.LEDGER_SEGMENT2)).otherwise(F.lit("620"))
        return ids.select(k, s1.alias("segment1"), _s("Company ", s1).alias("segment1_desc"),
                          s2.alias("segment2"), _s("Account ", s2).alias("segment2_desc"))

    @_memo
    def salesreps(self) -> DataFrame:
        s = self.t["supplier"]
        return s.select(F.col("s_suppkey").alias("salesrep_id"), F.col("s_name").alias("salesrep_name"))

    @_memo
    def order_headers(self) -> DataFrame:
        o = self.t["orders"]
        k = F.col("o_orderkey")
        opp = (F.when(k % 13 == 0, F.lit(None).cast("string"))
               .when(k % 29 == 0, F.lit("   "))
               .when(k % 5 == 0, _s(" \tOP-", k, "  "))
               .otherwise(_s("OP-", k)))
        return o.select(k.alias("header_id"), (k + 1000000).alias("order_number"),
                        opp.alias("attribute11"), (F.col("o_custkey") % 10).alias("salesrep_id"),
                        F.col("o_custkey").alias("invoice_to_org_id"))

    @_memo
    def rep_groups(self) -> DataFrame:
        g = self.t["supplier"].select(F.col("s_nationkey").alias("group_id")).distinct()
        k = F.col("group_id")
        name = F.when(k % 4 == 0, _s("XX Group ", k)).otherwise(_s(K.REP_GROUP_PREFIX, " Group ", k))
        return g.withColumn("group_name", name)

    @_memo
    def group_members(self) -> DataFrame:
        s = self.t["supplier"]
        return s.select(F.col("s_nationkey").alias("group_id"), F.col("s_suppkey").alias("resource_id"),
                        F.when(F.col("s_suppkey") % 7 == 3, F.lit("Y")).otherwise(F.lit("N"))
                        .alias("delete_flag"))

    @_memo
    def reps(self) -> DataFrame:
        s = self.t["supplier"]
        k = F.col("s_suppkey")
        return s.select(k.alias("resource_id"), k.alias("salesrep_id"), k.alias("person_id"),
                        F.when(k % 4 == 1, F.lit(None).cast("string")).otherwise(_s("Rep ", k))
                        .alias("name"))

    @_memo
    def people(self) -> DataFrame:
        s = self.t["supplier"]
        k = F.col("s_suppkey") % 6
        start = F.when(k == 5, F.lit(_dt.date(1999, 7, 15))).otherwise(F.lit(_dt.date(1990, 1, 1)))
        end = (F.when(k.isin(0, 5), F.lit(None).cast("date"))
               .when(k == 2, F.lit(_dt.date(1999, 6, 30)))
               .when(k == 3, F.lit(_dt.date(1998, 1, 1)))
               .otherwise(F.lit(_dt.date(2005, 1, 1))))
        return s.select(F.col("s_suppkey").alias("person_id"), F.col("s_name").alias("full_name"),
                        start.alias("effective_start_date"), end.alias("effective_end_date"))

    @_memo
    def order_lines(self) -> DataFrame:
        li = self.t["lineitem"]
        g = li.groupBy(_line_id().alias("line_id")).agg(F.min("l_partkey").alias("item"))
        return g.select("line_id", (F.col("line_id") / 10).cast("long").alias("header_id"),
                        _s("IT", F.col("item")).alias("ordered_item"),
                        F.col("item").alias("inventory_item_id"))

    @_memo
    def item_master(self) -> DataFrame:
        p = self.t["part"]
        return p.select(F.col("p_partkey").alias("inventory_item_id"),
                        F.when(F.col("p_partkey") % 10 == 0, F.lit(84))
                         .otherwise(F.lit(K.HOLD_ORGANIZATION_ID)).alias("organization_id"))

    @_memo
    def cust_accounts(self) -> DataFrame:
        c = self.t["customer"]
        return c.select(F.col("c_custkey").alias("cust_account_id"),
                        _s("AC", F.col("c_custkey")).alias("account_number"),
                        F.col("c_name").alias("account_name"))

    @_memo
    def acct_sites(self) -> DataFrame:
        c = self.t["customer"]
        return c.select(F.col("c_custkey").alias("cust_acct_site_id"),
                        F.col("c_custkey").alias("cust_account_id"))

    @_memo
    def site_uses(self) -> DataFrame:
        c = self.t["customer"]
        return c.select(F.col("c_custkey").alias("site_use_id"),
                        F.col("c_custkey").alias("cust_acct_site_id"))

    @_memo
    def order_holds(self) -> DataFrame:
        ids = self.t["lineitem"].select(_line_id().alias("line_id")).distinct()
        k = F.col("line_id")
        return ids.select(k, (k % 3).alias("hold_source_id"),
                          F.when(k % 4 == 0, k).alias("hold_release_id"))

    @_memo
    def hold_sources(self) -> DataFrame:
        ids = self.line_codes().select(F.col("hold_code").alias("hold_source_id")).distinct()
        k = F.col("hold_source_id")
        return ids.select(k, k.alias("hold_id"),
                          F.date_add(F.lit(_dt.date(2002, 1, 1)), k.cast("int")).alias("hold_until_date"))

    @_memo
    def hold_definitions(self) -> DataFrame:
        ids = self.line_codes().select(F.col("hold_code").alias("hold_id")).distinct()
        k = F.col("hold_id")
        return ids.select(k, F.when(k == 1, F.lit("Credit Hold")).otherwise(F.lit(K.HOLD_NAME))
                          .alias("name"))

    def order_base(self) -> dict[str, DataFrame]:
        """Every order-system base table the extracts read."""
        return {n: getattr(self, n)() for n in ORDER_BASE_TABLES}

    # -- CRM objects (unprefixed, as exported) -----------------------------
    @_memo
    def crm_transaction(self) -> DataFrame:
        return self.transactions().where(F.col("Transaction_Type__c").isin(*K.CRM_TRANSACTION_TYPES))

    @_memo
    def crm_offering(self) -> DataFrame:
        return self.transactions().select("Offering__c", "Product_Number__c", "Product__c",
                                          "Transaction_Month__c")

    @_memo
    def crm_account(self) -> DataFrame:
        c = self.t["customer"]
        n = self.t["nation"].select("n_nationkey", "n_regionkey")
        r = self.t["region"].select("r_regionkey", "r_name")
        geo = bounded_broadcast(n.join(bounded_broadcast(r), n.n_regionkey == r.r_regionkey))
        x = c.join(geo, c.c_nationkey == geo.n_nationkey, "left")
        k = F.col("c_custkey")
        return x.select(_s("ACC", k).alias("Id"),
                        F.when(k % 10 == 3, F.lit(None).cast("string")).otherwise(k.cast("string"))
                        .alias("Party_ID__c"),
                        _s("USR", k % 10).alias("OwnerId"), F.col("c_name").alias("Name"),
                        _s("R", F.col("c_nationkey")).alias("Region__c"),
                        F.col("r_name").alias("Sales_Region_text__c"))

    @_memo
    def crm_user(self) -> DataFrame:
        s = self.t["supplier"]
        return s.select(_s("USR", F.col("s_suppkey")).alias("Id"), F.col("s_name").alias("Name"))

    def _opp_number(self) -> Column:
        k = F.col("o_orderkey")
        return F.when(k.isin(7, 8), F.lit(None).cast("string")).otherwise(_s("OP-", k))

    @_memo
    def crm_opportunity(self) -> DataFrame:
        o = self.t["orders"]
        k = F.col("o_orderkey")
        d = F.to_date("o_orderdate")
        st = F.col("o_orderstatus")
        return o.select(
            _s("OPP", k).alias("Id"), self._opp_number().alias("Opportunity__c"),
            F.trunc(F.date_add(d, 45), "month").alias("Month_Close__c"),
            F.date_add(d, 30).alias("CloseDate"),
            F.when(k % 13 == 0, F.lit(None).cast("double")).otherwise(((k % 11) * 10).cast("double"))
             .alias("Probability"),
            F.when(st == "F", F.lit("Closed Won")).when(st == "O", F.lit("Negotiation"))
             .otherwise(F.lit("Proposal")).alias("StageName"),
            F.when(k % 2 == 0, F.lit("New")).otherwise(F.lit("Renewal")).alias("Type"),
            money("o_totalprice").alias("Amount"),
            _s("LNK", k % 10).alias("Owner_Link__c"),
            _s("USR", k % 10).alias("OwnerId"),
        )

    @_memo
    def crm_opportunity_account(self) -> DataFrame:
        """Opportunity with its parent account as a nested record."""
        o = self.t["orders"]
        acct = F.when(F.col("o_custkey") % 7 == 0, F.lit(None)).otherwise(
            F.struct(_s("ACC", F.col("o_custkey")).alias("Id")))
        return o.select(self._opp_number().alias("Opportunity__c"), acct.alias("Account"))

    @_memo
    def crm_parent(self) -> DataFrame:
        c = self.t["customer"]
        k = F.col("c_custkey")
        return c.select(_s("ACC", k - k % 10).alias("Id"),
                        F.when(k % 9 == 4, F.lit(None).cast("string")).otherwise(_s("RG", k))
                        .alias("Registry_ID__c"))

    @_memo
    def crm_project(self) -> DataFrame:
        o = self.t["orders"]
        k = F.col("o_orderkey")
        stages = ["Scheduled", "Unscheduled", "Soft Scheduled", "Project Initiated",
                  "Closed", "Canceled", "On Hold"]
        stage = None
        for i, s in enumerate(stages):
            stage = F.when(k % 8 == i, F.lit(s)) if stage is None else stage.when(k % 8 == i, F.lit(s))
        return o.select(_s("PRJ", k).alias("Id"), _s("Project ", k).alias("Name"),
                        _s("PN", k).alias("Project_Number__c"), stage.alias("pse__Stage__c"))

    @_memo
    def crm_milestone(self) -> DataFrame:
        o = self.t["orders"]
        k = F.col("o_orderkey")
        d = F.to_date("o_orderdate")
        rt = list(K.MILESTONE_RECORD_TYPES)
        rtype = (F.when(k % 4 == 0, F.lit(rt[0])).when(k % 4 == 1, F.lit(rt[1]))
                 .when(k % 4 == 2, F.lit(rt[2])).otherwise(F.lit("RT-OTHER")))
        return o.select(
            _s("MS", k).alias("Id"), _s("Milestone ", k).alias("Name"), rtype.alias("RecordTypeId"),
            F.date_add(d, 60).alias("pse__Target_Date__c"),
            F.when(k % 2 == 0, F.date_add(d, 75)).alias("pse__Actual_Date__c"),
            F.when(F.col("o_orderstatus") == "F", F.lit("Complete")).otherwise(F.lit("Open"))
             .alias("pse__Status__c"),
            F.when(k % 3 == 0, _s("OL", k)).alias("Opportunity_Line_Item_Id__c"),
            F.when(k % 4 != 3, _s("ORD", k)).alias("Order__c"),
            _s("USR", k % 7).alias("Engagement_Manager__c"),
            _s("USR", k % 5).alias("Psa_Group_Owner__c"),
            ((k % 5) * 20).cast("double").alias("Probability__c"),
        )

    @_memo
    def crm_order(self) -> DataFrame:
        o = self.t["orders"]
        k = F.col("o_orderkey")
        return o.select(_s("ORD", k).alias("Id"), _s("SO-", k).alias("Name"),
                        _s("OP-", k).alias("Opportunity_Number__c"), _s("OPP", k).alias("Opportunity__c"))

    @_memo
    def crm_opportunity_line(self) -> DataFrame:
        o = self.t["orders"]
        k = F.col("o_orderkey")
        return o.select(_s("OL", k).alias("Id"), _s("Line ", k).alias("Name"),
                        _s("OPP", k + 1).alias("OpportunityId"))

    def crm_builders(self) -> dict:
        """CRM extract name -> method building it."""
        return {
            "Fact_Trx": self.crm_transaction,
            "Ref_Acct": self.crm_account,
            "Ref_Mile": self.crm_milestone,
            "Ref_Opps": self.crm_opportunity,
            "Ref_Proj": self.crm_project,
            "Ref_User": self.crm_user,
            "Ref_Prnt": self.crm_parent,
            "Ref_Offr": self.crm_offering,
            "Ref_Order": self.crm_order,
            "Ref_Oppline": self.crm_opportunity_line,
            "Ref_Opps_Acct": self.crm_opportunity_account,
        }

    def crm_objects(self) -> dict[str, DataFrame]:
        """The CRM extracts by name, as exported (no prefixes yet)."""
        return {n: build() for n, build in self.crm_builders().items()}

    # -- rule tables (configuration, not data) -----------------------------
    def zero_party_date_rules(self) -> DataFrame:
        rows = [(int(p), _dt.date.fromisoformat(d)) for p, d in DRIVER_ZERO_PARTY_DATES]
        return self.spark.createDataFrame(rows, "party_id long, date_field date")

    def zero_order_rules(self) -> DataFrame:
        return self.spark.createDataFrame([(int(o),) for o in DRIVER_ZERO_ORDERS], "order_header_id long")
