"""Order-side extracts: the order system's fact queries as DataFrame plans.

Each extract is a star join of a line-level fact with its dimensions,
filtered and summed. Written once with the DataFrame API, so Catalyst pushes
the dimension filters into the scans, prunes columns and (with AQE) picks
broadcast or shuffle joins from real sizes. Calendar and code tables are
bounded by construction and are broadcast behind a size check; customers,
parties and products grow with the business and are left to the optimizer.

Output names follow the order system (upper-case, a few quoted names), as
the later steps address columns by them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.fiscal import fiscal_period
from ..functions.rules import apply_overrides, hold_category, revenue_type_by_date
from ..functions.semantics import exclude_drop_null, product_key, trim_to_null
from ..operators.joins import left_enrich
from ..operators.projection import project_strict, rename_map, project_lenient
from ..operators.rule_match import match_rules
from ..operators.sets import union_by_name
from ..operators.sizes import auto_broadcast_bytes, bounded_broadcast, fits_broadcast, memory_bytes, sized_join
from ._lazy import LazyMap
from .config import ForecastConfig

Catalog = Mapping[str, DataFrame]


def _c(name: str):
    return F.col(f"`{name}`")


def _product_cols(prd: DataFrame) -> DataFrame:
    return prd.select(
        "inventory_item_id",
        F.col("product_number").alias("PRODUCT_NUMBER"),
        F.col("format").alias("FORMAT"),
        F.col("language").alias("LANGUAGE"),
        product_key("product_number", "format", "language").alias("PRODUCT_NUMBER_CONCAT"),
        F.col("title_abbreviation").alias("TITLE_ABBREVIATION"),
    )


def _customer_cols(cat: Catalog):
    pa = cat["parties"].select(F.col("party_id").alias("_pa_id"),
                               F.col("party_name").alias("PARTY_NAME"),
                               F.col("party_number").alias("PARTYNUMBER_AKA_REGISTRYID"))
    cb = cat["customers_bill_to"].select(
        F.col("cust_account_id").alias("BILL_TO_ACCOUNT_ID"),
        F.col("account_name").alias("BILL_TO_ACCOUNT_NAME"),
        F.col("account_number").alias("BILL_TO_ACCOUNT_NUMBER"),
        F.col("parent_number").alias("PARENTNUMBER_AKA_PARENTREGID"),
        F.col("parent_name").alias("BILL_TO_PARENT_NAME"))
    cs = cat["customers_sold_to"].select(
        F.col("cust_account_id").alias("SOLD_TO_ACCOUNT_ID"),
        F.col("account_name").alias("SOLD_TO_ACCOUNT_NAME"),
        F.col("account_number").alias("SOLD_TO_ACCOUNT_NUMBER"))
    return pa, cb, cs


def _told_apart(dim: DataFrame, key: str, wanted: Sequence[str] | None, number: str, by_key: bool = True) -> DataFrame:
    """A dimension without the attributes that are not ``wanted``, and a number in their place.

    The extracts are grouped by all attributes, whether they keep them or not. Rows of one
    key get the same number just where these are the same, so grouping by key, wanted
    ones and number makes the same groups, and the others need not go through the
    shuffles. Where the key is not grouped by (``by_key`` false), a second column has the
    first key of the same attributes. None: all are wanted."""
    attributes = [c for c in dim.columns if c != key]
    dropped = [c for c in attributes if wanted is not None and c not in wanted]
    if not dropped:
        return dim
    dim = dim.withColumn(number, F.dense_rank().over(Window.partitionBy(_c(key)).orderBy(*[_c(c) for c in dropped])))
    if not by_key:  # the first key that has these attributes, and their number there
        alike = Window.partitionBy(*[_c(c) for c in attributes])
        dim = dim.withColumn("_first", F.min(F.struct(_c(key), _c(number))).over(alike)).withColumns(
            {number: F.col("_first").getField(number), number + "_of": F.col("_first").getField(key)}).drop("_first")
    return dim.drop(*dropped)


def _grouping(f: DataFrame, keys: Sequence[str]) -> list[str]:
    """The keys of an extract's grouping, with numbers in the place of attributes that are gone."""
    return [k for k in keys if k in f.columns] + [n for n in _NUMBERS if n in f.columns]


_NUMBERS = ("_prd_no", "_prd_no_of", "_pa_no", "_cb_no", "_cs_no")


def _attach_dimensions(f: DataFrame, cat: Catalog, prd: DataFrame, wanted: Sequence[str] | None = None,
                       placed: bool = False) -> DataFrame:
    """Inner join to the product, left joins to sold-to customer, bill-to customer and party
    (SQL semantics: a null key matches nothing).

    Where these are too large to broadcast, what a join adds goes through the
    shuffles of the next ones, so the party comes last: its key is one of the extracts'
    grouping keys, and the final grouping finds its rows in place, without another shuffle
    of the widest rows. Attributes that are not ``wanted`` are left out (``_told_apart``).
    Where all of them are small, ``placed`` rows are put in place for the final grouping
    before they get wide, by two of its keys (orders may be unknown, parties large).
    """
    pa, cb, cs = _customer_cols(cat)
    # Sizes are those of the dimensions as they are; broadcasts are kept: adaptive execution
    # would go by what their windows shuffle, all attributes.
    small = [fits_broadcast(d, auto_broadcast_bytes(d)) for d in (prd, pa, cb, cs)]
    prd = _told_apart(prd, "inventory_item_id", wanted, "_prd_no", by_key=False)
    pa, cb, cs = (_told_apart(pa, "_pa_id", wanted, "_pa_no"), _told_apart(cb, "BILL_TO_ACCOUNT_ID", wanted, "_cb_no"),
                  _told_apart(cs, "SOLD_TO_ACCOUNT_ID", wanted, "_cs_no"))
    if placed and all(small):
        f = f.repartition("order_header_id", "bill_to_party_id")
    f = sized_join(f, cs, F.col("sold_to_customer_id") == F.col("SOLD_TO_ACCOUNT_ID"), "left", small=small[3])
    f = sized_join(f, cb, F.col("bill_to_customer_id") == F.col("BILL_TO_ACCOUNT_ID"), "left", small=small[2])
    f = sized_join(f, prd, "inventory_item_id", small=small[0])
    return sized_join(f, pa, F.col("bill_to_party_id") == F.col("_pa_id"), "left", small=small[1]).drop("_pa_id")


def _dates(cat: Catalog, cfg: ForecastConfig, lo: int | None, hi: int | None) -> DataFrame:
    dt = cat["dim_dates"]
    if lo is not None:
        dt = dt.where(F.col("fiscal_yyyymm") >= lo)
    if hi is not None:
        dt = dt.where(F.col("fiscal_yyyymm") <= hi)
    dt = dt.select("date_key", F.col("fiscal_yyyymm").alias("FISCAL_YYYYMM"),
                   F.col("date_field").alias("Transaction Date"))
    return bounded_broadcast(dt, cfg.broadcast_ceiling)


def _source_codes(cat: Catalog, cfg: ForecastConfig, descriptions) -> DataFrame:
    ps = (cat["pipeline_sources"].where(F.col("description").isin(list(descriptions)))
          .select(F.col("pipeline_source").alias("_ps_code")))
    return bounded_broadcast(ps, cfg.broadcast_ceiling)


_FACT_KEYS = ("order_header_id", "inventory_item_id", "bill_to_party_id", "bill_to_customer_id",
              "sold_to_customer_id")


def _fk_sum(f: DataFrame, keys, measures) -> DataFrame:
    """Sum the filtered fact at its foreign-key grain before the growing
    dimensions (products, parties, customers) are joined.

    Those joins are shuffle joins at scale; joining one row per key
    combination instead of one per line shrinks every one of them, and the
    grouping itself combines partially before its own shuffle. Exact:
    a sum distributes over the dimension joins (fan-out included), and the
    final grouping re-adds the partial sums.
    """
    return f.groupBy(*[_c(k) for k in keys]).agg(*[F.sum(_c(m)).alias(m) for m in measures])


_PIPELINE_KEYS = (
    "PRODUCT_NUMBER", "FORMAT", "LANGUAGE", "PRODUCT_NUMBER_CONCAT", "TITLE_ABBREVIATION",
    "BILL_TO_PARTY_ID", "PARTY_NAME", "PARTYNUMBER_AKA_REGISTRYID", "BILL_TO_ACCOUNT_ID",
    "BILL_TO_ACCOUNT_NAME", "BILL_TO_ACCOUNT_NUMBER", "PARENTNUMBER_AKA_PARENTREGID",
    "BILL_TO_PARENT_NAME", "SOLD_TO_ACCOUNT_ID", "SOLD_TO_ACCOUNT_NAME",
    "SOLD_TO_ACCOUNT_NUMBER", "ebs_rep", "FISCAL_YYYYMM", "Transaction Date",
    "ORDER_HEADER_ID",
)


def billing_events_fact(cat: Catalog, cfg: ForecastConfig, wanted: Sequence[str] | None = None) -> DataFrame:
    """A1: future billing per product, customer, rep, day and order. ``wanted`` (here and in
    the next two): the attributes of products and customers that the caller keeps, else all.

    Order lines whose accounting rule is excluded or null, excluded
    products and resources are dropped (SQL ``NOT IN`` drops nulls).
    """
    pd_ = cat["pipeline_detail"]
    dt = _dates(cat, cfg, cfg.billing_min_period, None)
    prd = _product_cols(cat["products"].where(
        exclude_drop_null("product_number", cfg.billing_excluded_products)))
    ps = _source_codes(cat, cfg, cfg.billing_sources)
    pol = (cat["pipeline_order_lines"]
           .where(exclude_drop_null("accounting_rule", cfg.billing_excluded_accounting_rules))
           .select(F.col("order_line_id").alias("_pol_id")))
    pr = (cat["pipeline_resources"]
          .where(exclude_drop_null("resource_id", cfg.billing_excluded_resources))
          .select(F.col("resource_id").alias("_pr_id"), F.col("resource_name").alias("ebs_rep")))
    f = (pd_.join(dt, pd_.transaction_date_key == dt.date_key)
         .join(ps, pd_.pipeline_source == ps._ps_code))
    f = sized_join(f, pol, pd_.order_line_id == pol._pol_id)
    f = sized_join(f, pr, pd_.resource_id == pr._pr_id)
    f = _fk_sum(f, _FACT_KEYS + ("FISCAL_YYYYMM", "Transaction Date", "ebs_rep"), ["future_billing_amount"])
    f = _attach_dimensions(f, cat, prd, wanted).withColumn("ORDER_HEADER_ID", F.col("order_header_id")) \
        .withColumn("BILL_TO_PARTY_ID", F.col("bill_to_party_id"))
    out = f.groupBy(*[_c(k) for k in _grouping(f, _PIPELINE_KEYS)]).agg(
        F.sum("future_billing_amount").alias("Amount"))
    return out.withColumn("Revenue Type ID", F.lit(K.BILLING_TYPE))


_LEDGER_KEYS = (
    "SEGMENT1", "SEGMENT1_DESC", "SEGMENT2", "SEGMENT2_DESC",
    "PRODUCT_NUMBER", "FORMAT", "LANGUAGE", "PRODUCT_NUMBER_CONCAT", "TITLE_ABBREVIATION",
    "BILL_TO_PARTY_ID", "SALESREP_ID", "ebs_rep", "PARTY_NAME", "PARTYNUMBER_AKA_REGISTRYID",
    "BILL_TO_ACCOUNT_ID", "BILL_TO_ACCOUNT_NAME", "BILL_TO_ACCOUNT_NUMBER",
    "PARENTNUMBER_AKA_PARENTREGID", "BILL_TO_PARENT_NAME", "SOLD_TO_ACCOUNT_ID",
    "SOLD_TO_ACCOUNT_NAME", "SOLD_TO_ACCOUNT_NUMBER", "FISCAL_YYYYMM", "Transaction Date",
    "ORDER_HEADER_ID",
)


def recognised_deferred_fact(cat: Catalog, cfg: ForecastConfig, wanted: Sequence[str] | None = None) -> DataFrame:
    """A2: ledger revenue per segment, product, customer, rep, day, order;
    type 1 (recognised) up to the day before ``as_of``, else 2."""
    sd = cat["sales_detail"]
    cc = (cat["gl_code_combos"]
          .where((F.col("segment1") == cfg.ledger_segment1) & (F.col("segment2") == cfg.ledger_segment2))
          .select(F.col("code_combination_id").alias("_cc_id"),
                  F.col("segment1").alias("SEGMENT1"), F.col("segment1_desc").alias("SEGMENT1_DESC"),
                  F.col("segment2").alias("SEGMENT2"), F.col("segment2_desc").alias("SEGMENT2_DESC")))
    dt = _dates(cat, cfg, cfg.ledger_min_period, cfg.ledger_max_period)
    prd = _product_cols(cat["products"])
    sr = cat["salesreps"].select(F.col("salesrep_id").alias("_sr_id"),
                                 F.col("salesrep_name").alias("ebs_rep"))
    f = (sd.join(bounded_broadcast(cc, cfg.broadcast_ceiling), sd.code_combination_id == cc._cc_id)
         .join(dt, sd.gl_date_key == dt.date_key))
    f = _fk_sum(f, _FACT_KEYS + ("salesrep_id", "SEGMENT1", "SEGMENT1_DESC", "SEGMENT2", "SEGMENT2_DESC",
                                 "FISCAL_YYYYMM", "Transaction Date"), ["line_amount"])
    f = _attach_dimensions(f, cat, prd, wanted)
    f = (sized_join(f, sr, f.salesrep_id == sr._sr_id, "left")
         .withColumn("ORDER_HEADER_ID", F.col("order_header_id"))
         .withColumn("BILL_TO_PARTY_ID", F.col("bill_to_party_id"))
         .withColumn("SALESREP_ID", F.col("salesrep_id")))
    out = f.groupBy(*[_c(k) for k in _grouping(f, _LEDGER_KEYS)]).agg(F.sum("line_amount").alias("Amount"))
    return out.withColumn("Revenue Type ID", revenue_type_by_date(_c("Transaction Date"), F.lit(cfg.as_of)))


def zero_rules(party_date_rules: DataFrame | None = None, order_rules: DataFrame | None = None,
               open_rules: DataFrame | None = None) -> DataFrame | None:
    """One rule table (party_id, date_field, order_header_id; null: any) of rules by
    party and day, rules by order, and rules that have open fields already. In the first
    two a null fits nothing, as in a join."""
    parts = []
    if party_date_rules is not None:
        parts.append(party_date_rules.where("party_id is not null and date_field is not null").select(
            "party_id", "date_field", F.lit(None).cast("long").alias("order_header_id")))
    if order_rules is not None:
        parts.append(order_rules.where("order_header_id is not null").select(
            F.lit(None).cast("long").alias("party_id"), F.lit(None).cast("date").alias("date_field"), "order_header_id"))
    if open_rules is not None:
        parts.append(open_rules.select("party_id", "date_field", "order_header_id"))
    return reduce(DataFrame.unionByName, parts) if parts else None


def contracted_tcv_fact(cat: Catalog, cfg: ForecastConfig, party_date_rules: DataFrame | None = None,
                        order_rules: DataFrame | None = None, open_rules: DataFrame | None = None,
                        wanted: Sequence[str] | None = None) -> DataFrame:
    """A3: open and closed order value per product, customer, rep, day and
    order, and their total, zeroed where a rule says the order was already
    invoiced.

    Rules come as ``party_date_rules(party_id, date_field)``,
    ``order_rules(order_header_id)`` or ``open_rules`` with all three fields, of which
    any may be open (null). A row hit by several rules is still one row
    (``operators.rule_match``).
    """
    pd_ = cat["pipeline_detail"]
    dt = _dates(cat, cfg, cfg.contract_min_period, cfg.contract_max_period)
    prd = _product_cols(cat["products"].where(
        exclude_drop_null("product_number", cfg.contract_excluded_products)))
    ps = _source_codes(cat, cfg, cfg.contract_sources)
    pr = (cat["pipeline_resources"]
          .where(exclude_drop_null("resource_id", cfg.contract_excluded_resources))
          .select(F.col("resource_id").alias("_pr_id"), F.col("resource_name").alias("ebs_rep")))
    ph = (cat["pipeline_headers"]
          .where(~F.col("transaction_no").startswith(cfg.pro_forma_prefix))
          .select(F.col("pipeline_header_id").alias("_ph_id"),
                  F.col("pipeline_source").alias("_ph_src")))
    f = (pd_.join(dt, pd_.transaction_date_key == dt.date_key)
         .join(ps, pd_.pipeline_source == ps._ps_code))
    f = sized_join(f, pr, pd_.resource_id == pr._pr_id)
    f = sized_join(f, ph, (pd_.pipeline_header_id == ph._ph_id) & (pd_.pipeline_source == ph._ph_src))
    # Summed where the headers' join has put the rows, by its keys too: one shuffle for both.
    # The final grouping adds up what several headers of an order leave apart.
    header = ("pipeline_header_id", "pipeline_source")
    f = _fk_sum(f, header + _FACT_KEYS + ("FISCAL_YYYYMM", "Transaction Date", "ebs_rep"),
                ["open_order_amount", "closed_order_amount"]).drop(*header)
    f = (_attach_dimensions(f, cat, prd, wanted, placed=True).withColumn("ORDER_HEADER_ID", F.col("order_header_id"))
         .withColumn("BILL_TO_PARTY_ID", F.col("bill_to_party_id")))
    out = f.groupBy(*[_c(k) for k in _grouping(f, _PIPELINE_KEYS)]).agg(
        F.sum("open_order_amount").alias("Open Order Amount"),
        F.sum("closed_order_amount").alias("Closed Order Amount"))
    rules = zero_rules(party_date_rules, order_rules, open_rules)
    total = _c("Closed Order Amount") + _c("Open Order Amount")
    if rules is None:
        return out.withColumn("Amount", total).withColumn("Revenue Type ID", F.lit(K.CONTRACT_TYPE))
    # Of the two tables of given fields each has its mask; rules with open fields are looked at.
    known = {0b011: None, 0b100: None} if open_rules is None else None
    out = match_rules(out, rules, {"party_id": "BILL_TO_PARTY_ID", "date_field": "Transaction Date",
                                   "order_header_id": "ORDER_HEADER_ID"}, out="zero", masks=known)
    amount = F.when(F.col("zero_mask").isNotNull(), F.lit(0).cast("decimal(18,2)")).otherwise(total)
    return (out.withColumn("Amount", amount).drop("zero_mask")
            .withColumn("Revenue Type ID", F.lit(K.CONTRACT_TYPE)))


def po_hold_fact(cat: Catalog, cfg: ForecastConfig) -> DataFrame:
    """A4: future billing of order lines on a multi-year contract hold.

    The hold category is 'PO Hold' only for flagged lines, and the original
    kept only that category and non-zero sums; the category filter is
    applied before grouping. Items must exist in the configured inventory
    organisation (a semi join: the item master does not multiply rows).
    Hold releases are not consulted, so released holds still count.
    """
    holds = sized_join(cat["order_holds"], cat["hold_sources"], "hold_source_id")
    holds = (sized_join(holds, cat["hold_definitions"].where(F.col("name") == cfg.hold_name), "hold_id")
             .select(F.col("line_id").alias("_h_line"), F.col("hold_until_date").alias("HOLD_UNTIL_DATE")))
    pol = (cat["pipeline_order_lines"].where(hold_category("po_hold") == K.HOLD_CATEGORY)
           .select(F.col("order_line_id").alias("_pol_id"),
                   hold_category("po_hold").alias("FORECAST_CATEGORY")))
    # The holds and the flag are the selective inputs: they cut the lines
    # first, and what is left is summed before the account tables join.
    held = sized_join(holds, pol, holds._h_line == pol._pol_id)
    lines = held.select("_pol_id").distinct()
    detail = cat["pipeline_detail"]
    future = (sized_join(detail, lines, detail.order_line_id == lines._pol_id, "left_semi")
              .groupBy(F.col("order_line_id").alias("_line"), F.col("order_header_id").alias("_header"),
                       F.col("transaction_date_key").alias("_day"))
              .agg(F.sum("future_billing_amount").alias("_amount")))
    days = bounded_broadcast(cat["dim_dates"].select(F.col("date_key").alias("_day"),
                                                     F.col("date_field").alias("BILLING_EVENT_DATE")),
                             cfg.broadcast_ceiling)
    items = (cat["item_master"].where(F.col("organization_id") == cfg.hold_organization_id)
             .select(F.col("inventory_item_id").alias("_item")))
    line = cat["order_lines"].select(F.col("line_id").alias("_line"), F.col("header_id").alias("_header"),
                                     F.col("ordered_item").alias("PRODUCT"),
                                     F.col("inventory_item_id").alias("_item"))
    line = sized_join(line, items, "_item", "left_semi")
    header = cat["order_headers"].select(F.col("header_id").alias("_header"),
                                         F.col("order_number").alias("ORDER_NUMBER"),
                                         F.col("salesrep_id").alias("SALESREP_ID"),
                                         F.col("invoice_to_org_id").alias("_site_use"))
    sites = cat["site_uses"].select(F.col("site_use_id").alias("_site_use"), F.col("cust_acct_site_id").alias("_site"))
    accounts_of = cat["acct_sites"].select(F.col("cust_acct_site_id").alias("_site"),
                                           F.col("cust_account_id").alias("_account"))
    accounts = cat["cust_accounts"].select(F.col("cust_account_id").alias("_account"),
                                           F.col("account_number").alias("BILL_TO_PARTY"),
                                           F.col("account_name").alias("ACCOUNT_NAME"))
    f = sized_join(future, held.withColumnRenamed("_pol_id", "_line"), "_line")
    reps = cat["salesreps"].select(F.col("salesrep_id").alias("SALESREP_ID"))
    for right, keys in ((line, ["_line", "_header"]), (header, "_header"), (reps, "SALESREP_ID"), (sites, "_site_use"),
                        (accounts_of, "_site"), (accounts, "_account")):
        f = sized_join(f, right, keys)
    f = f.join(days, "_day")
    keys = ("BILL_TO_PARTY", "ACCOUNT_NAME", "ORDER_NUMBER", "HOLD_UNTIL_DATE",
            "BILLING_EVENT_DATE", "FORECAST_CATEGORY", "PRODUCT", "SALESREP_ID")
    out = f.groupBy(*keys).agg(F.sum("_amount").cast("decimal(28,2)").alias("NET_AMOUNT"))
    return out.where(F.col("NET_AMOUNT") != 0)


def order_opportunity_map(cat: Catalog, cfg: ForecastConfig) -> DataFrame:
    """Order header -> opportunity id and its current sales rep.

    Reps count when their group name starts with the configured prefix,
    their membership is not deleted, they are not excluded and their person
    record is effective at ``as_of`` (an open end counts as effective). The
    opportunity id is trimmed; a blank id becomes null.
    """
    as_of = F.lit(cfg.as_of).cast("timestamp")
    rg = cat["rep_groups"].where(F.col("group_name").startswith(cfg.rep_group_prefix)).select("group_id")
    rgm = cat["group_members"].where(F.col("delete_flag") == "N").select("group_id", "resource_id")
    rep = (cat["reps"].where(exclude_drop_null("salesrep_id", cfg.excluded_salesreps))
           .select("resource_id", "salesrep_id", "person_id", F.col("name").alias("_rep_name")))
    per = cat["people"]
    end = F.coalesce(F.col("effective_end_date").cast("timestamp"), as_of + F.expr("INTERVAL 1 DAY"))
    per = per.where(as_of.between(F.col("effective_start_date").cast("timestamp"), end)) \
        .select("person_id", "full_name")
    reps = sized_join(sized_join(sized_join(rg, rgm, "group_id"), rep, "resource_id"), per, "person_id")
    reps = (reps.select(F.col("salesrep_id").alias("_s_id"),
                    F.coalesce("_rep_name", "full_name").alias("SALESREP_NAME"))
            .distinct())
    oh = cat["order_headers"].where(F.col("attribute11").isNotNull())
    # Few reps have many orders: a join by their key would gather these. No estimate knows how few.
    j = sized_join(oh, reps, oh.salesrep_id == reps._s_id, small=memory_bytes(reps) <= auto_broadcast_bytes(oh))
    return j.select(F.col("header_id").alias("ORDER_HEADER_ID"),
                    F.col("header_id").alias("ORDER_HEADER_MAP_ID"),
                    F.col("order_number").alias("ORDER_NUMBER"),
                    trim_to_null("attribute11").alias("OPPORTUNITY_ID"),
                    F.col("_s_id").alias("SALESREP_ID"), "SALESREP_NAME")


# O1: the extracts' orders, at the sink only ("-": from the latest down; those that
# keep of their day the period alone are ordered by that).
EXTRACT_ORDER = {"billev": ("-FISCAL_YYYYMM",), "defrecrev": ("-Transaction Date",), "tcv": ("-FISCAL_YYYYMM",),
                 "reforderopp": ("ORDER_HEADER_ID",), "poh": ("ORDER_NUMBER",)}


def order_sources(cat: Catalog, cfg: ForecastConfig, party_date_rules: DataFrame | None = None,
                  order_rules: DataFrame | None = None, wrap=None,
                  open_rules: DataFrame | None = None) -> Mapping[str, DataFrame]:
    """The order-side tables the forecasts read.

    ``tcv``, ``billev``, ``defrecrev``, ``reforderopp``, ``poh`` (holds with
    their order header and fiscal period) and ``revfact``, the union of
    billing, ledger and hold rows with the revenue type as text. Each table
    is planned on first access. ``wrap`` turns the builders into the
    returned mapping (e.g. a landing layer); tables built from other
    tables read them through that mapping.
    """
    def tcv():
        return project_strict(contracted_tcv_fact(cat, cfg, party_date_rules, order_rules, open_rules,
                                                  K.TCV_EXTRACT_COLUMNS), K.TCV_EXTRACT_COLUMNS)

    def billev():
        return project_strict(billing_events_fact(cat, cfg, K.BILLING_EXTRACT_COLUMNS), K.BILLING_EXTRACT_COLUMNS)

    def defrecrev():
        return project_strict(recognised_deferred_fact(cat, cfg, K.LEDGER_EXTRACT_COLUMNS), K.LEDGER_EXTRACT_COLUMNS)

    def reforderopp():
        ref = project_strict(order_opportunity_map(cat, cfg), K.ORDER_MAP_EXTRACT_COLUMNS)
        return ref.withColumn("OPPORTUNITY_ID", apply_overrides("OPPORTUNITY_ID", cfg.opportunity_overrides))

    def poh():
        h = project_strict(po_hold_fact(cat, cfg), K.HOLD_EXTRACT_COLUMNS)
        h = left_enrich(h, out["reforderopp"], "ORDER_NUMBER", "ORDER_NUMBER")
        h = project_lenient(rename_map(h, K.HOLD_COLUMNS), list(K.HOLD_COLUMNS.values()))
        # Hold rows carry an account number in the party-id slot.
        return h.withColumn("FISCAL_YYYYMM", fiscal_period(_c("FISCAL_YYYYMM")))

    def revfact():
        text = ("Revenue Type ID", "BILL_TO_PARTY_ID")
        return union_by_name([out[n].withColumns({c: _c(c).cast("string") for c in text})
                              for n in ("billev", "defrecrev", "poh")])

    builders = {"tcv": tcv, "billev": billev, "defrecrev": defrecrev,
                "reforderopp": reforderopp, "poh": poh, "revfact": revfact}
    out = wrap(builders) if wrap else LazyMap(builders)
    return out
