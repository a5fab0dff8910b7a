"""Order-side extracts on hand-made tables (FIXTURES.md section 4)."""

import datetime as dt
from decimal import Decimal

from revcast.plans import orders as O
from revcast.plans.config import ForecastConfig

from conftest import rows

D = dt.date


def _cat(spark, **tables):
    return {name: spark.createDataFrame(data, ddl) for name, (data, ddl) in tables.items()}


def _base(spark, detail, extra=None):
    t = dict(
        pipeline_detail=(detail, "order_header_id long, order_line_id long, pipeline_header_id long, "
                                 "pipeline_source string, transaction_date_key long, inventory_item_id long, "
                                 "bill_to_party_id long, bill_to_customer_id long, sold_to_customer_id long, "
                                 "resource_id long, future_billing_amount decimal(18,2), "
                                 "open_order_amount decimal(18,2), closed_order_amount decimal(18,2)"),
        dim_dates=([(20200101, D(2020, 1, 1), 202007), (20200102, D(2020, 1, 2), 202007)],
                   "date_key long, date_field date, fiscal_yyyymm int"),
        products=([(1, "P1", "EB", None, "T1")],
                  "inventory_item_id long, product_number string, format string, language string, "
                  "title_abbreviation string"),
        pipeline_sources=([("A", "Future Billing"), ("N", "Open Order")], "pipeline_source string, description string"),
        parties=([(7, "Party7", "RG7")], "party_id long, party_name string, party_number string"),
        customers_bill_to=([(7, "Acct7", "AC7", "RG0", "Parent0")],
                           "cust_account_id long, account_name string, account_number string, "
                           "parent_number string, parent_name string"),
        customers_sold_to=([(7, "Acct7", "AC7")], "cust_account_id long, account_name string, account_number string"),
        pipeline_resources=([(1, "Rep1")], "resource_id long, resource_name string"),
        pipeline_headers=([(h, "N", "T1") for h in (1, 2, 3, 4)] + [(5, "N", "9X")],
                          "pipeline_header_id long, pipeline_source string, transaction_no string"),
    )
    t.update(extra or {})
    return _cat(spark, **t)


def _dec(x):
    return None if x is None else Decimal(x)


def _line(order, line, src, day, party, fb=None, open_=None, closed=None):
    return (order, line, order, src, day, 1, party, 7, 7, 1, _dec(fb), _dec(open_), _dec(closed))


def test_contracted_tcv_zero_out_rules(spark):
    detail = [_line(1, 11, "N", 20200101, 7, open_=10, closed=5),   # party+day rule
              _line(2, 21, "N", 20200102, 7, open_=10, closed=5),   # same party, other day
              _line(3, 31, "N", 20200102, 7, open_=10, closed=5),   # order rule
              _line(4, 41, "N", 20200102, 7, open_=10),             # closed sum is null
              _line(5, 51, "N", 20200102, 7, open_=10, closed=1)]   # pro-forma header: dropped
    cat = _base(spark, detail)
    rules_pd = spark.createDataFrame([(7, D(2020, 1, 1)), (7, D(2020, 1, 1))], "party_id long, date_field date")
    rules_o = spark.createDataFrame([(3,)], "order_header_id long")
    cfg = ForecastConfig(as_of="2020-06-30 00:00:00", contract_min_period=0, contract_max_period=999999,
                         contract_excluded_products=())
    out = O.contracted_tcv_fact(cat, cfg, rules_pd, rules_o)
    got = {r["ORDER_HEADER_ID"]: r["Amount"] for r in out.collect()}
    assert got[1] == 0 and got[2] == 15 and got[3] == 0 and got[4] is None
    assert 5 not in got
    assert rows(out, "PRODUCT_NUMBER_CONCAT")[0] == ("P1-EB-",)


def test_billing_fact_drops_null_and_excluded_rules(spark):
    detail = [_line(1, 11, "A", 20200101, 7, fb=5), _line(1, 12, "A", 20200101, 7, fb=7),
              _line(2, 21, "A", 20200101, None, fb=3), _line(3, 31, "A", 20200101, 7, fb=100),
              _line(4, 41, "N", 20200101, 7, fb=1)]
    extra = {"pipeline_order_lines": ([(11, "Std", "Y"), (12, "Std", None), (21, "Std", "N"),
                                       (31, "BLP Ratable", "Y"), (41, None, "Y")],
                                      "order_line_id long, accounting_rule string, po_hold string")}
    cat = _base(spark, detail, extra)
    cfg = ForecastConfig(billing_min_period=0)
    out = O.billing_events_fact(cat, cfg)
    got = {(r["ORDER_HEADER_ID"], r["BILL_TO_PARTY_ID"], r["PARTY_NAME"]): r["Amount"] for r in out.collect()}
    assert got == {(1, 7, "Party7"): 12, (2, None, None): 3}


def test_po_hold_fact(spark):
    detail = [_line(1, 11, "A", 20200101, 7, fb=5), _line(1, 12, "A", 20200101, 7, fb=6),
              _line(2, 21, "A", 20200101, 7, fb=4), _line(2, 22, "A", 20200101, 7, fb=-4),
              _line(3, 31, "A", 20200101, 7, fb=9), _line(4, 41, "A", 20200101, 7, fb=9)]
    extra = {
        "pipeline_order_lines": ([(11, "Std", "Y"), (12, "Std", "N"), (21, "Std", "Y"), (22, "Std", "Y"),
                                  (31, "Std", "Y"), (41, "Std", None)],
                                 "order_line_id long, accounting_rule string, po_hold string"),
        "order_lines": ([(11, 1, "IT1", 1), (12, 1, "IT1", 1), (21, 2, "IT1", 1), (22, 2, "IT1", 1),
                         (31, 3, "IT2", 2), (41, 4, "IT1", 1)],
                        "line_id long, header_id long, ordered_item string, inventory_item_id long"),
        "item_master": ([(1, 83), (2, 84)], "inventory_item_id long, organization_id int"),
        "order_headers": ([(h, 1000 + h, None, 1, 7) for h in (1, 2, 3, 4)],
                          "header_id long, order_number long, attribute11 string, salesrep_id long, "
                          "invoice_to_org_id long"),
        "salesreps": ([(1, "Rep1")], "salesrep_id long, salesrep_name string"),
        "site_uses": ([(7, 7)], "site_use_id long, cust_acct_site_id long"),
        "acct_sites": ([(7, 7)], "cust_acct_site_id long, cust_account_id long"),
        "cust_accounts": ([(7, "AC7", "Acct7")], "cust_account_id long, account_number string, account_name string"),
        "order_holds": ([(11, 1, 99), (12, 1, None), (21, 1, None), (22, 1, None), (31, 1, None), (41, 1, None)],
                        "line_id long, hold_source_id long, hold_release_id long"),
        "hold_sources": ([(1, 1, D(2021, 1, 1))], "hold_source_id long, hold_id long, hold_until_date date"),
        "hold_definitions": ([(1, "Multi-Year Contract Hold")], "hold_id long, name string"),
    }
    cat = _base(spark, detail, extra)
    out = O.po_hold_fact(cat, ForecastConfig())
    # line 11: flagged and released (still counts); 12: not flagged; order 2 sums to 0;
    # order 3: item in another organisation; order 4: flag null
    assert rows(out, "ORDER_NUMBER", "NET_AMOUNT", "FORECAST_CATEGORY", "BILL_TO_PARTY") == [
        (1001, 5, "PO Hold", "AC7")]


def test_order_opportunity_map_effective_dates(spark):
    as_of = "2020-06-30 12:00:00"
    t = dict(
        order_headers=([(h, 1000 + h, f"  OP-{h}\t", h, 0) for h in range(1, 7)] + [(7, 1007, None, 1, 0),
                                                                                     (8, 1008, "   ", 1, 0)],
                       "header_id long, order_number long, attribute11 string, salesrep_id long, "
                       "invoice_to_org_id long"),
        rep_groups=([(1, "CL East"), (2, "XX West")], "group_id long, group_name string"),
        group_members=([(1, 1, "N"), (1, 2, "N"), (1, 3, "N"), (1, 4, "N"), (1, 5, "Y"), (2, 6, "N")],
                       "group_id long, resource_id long, delete_flag string"),
        reps=([(r, r, r, None if r == 1 else f"Rep{r}") for r in range(1, 7)],
              "resource_id long, salesrep_id long, person_id long, name string"),
        people=([(1, "Person1", D(2019, 1, 1), None), (2, "Person2", D(2019, 1, 1), D(2021, 1, 1)),
                 (3, "Person3", D(2019, 1, 1), D(2020, 6, 30)), (4, "Person4", D(2020, 7, 1), None),
                 (5, "Person5", D(2019, 1, 1), None), (6, "Person6", D(2019, 1, 1), None)],
                "person_id long, full_name string, effective_start_date date, effective_end_date date"),
    )
    cat = _cat(spark, **t)
    out = O.order_opportunity_map(cat, ForecastConfig(as_of=as_of))
    # rep 1: open-ended (name from person); 2: current; 3: ended at midnight today; 4: not begun;
    # 5: membership deleted; 6: group without the prefix. Order 7 has no id; order 8 a blank id.
    assert rows(out, "ORDER_HEADER_ID", "OPPORTUNITY_ID", "SALESREP_NAME") == [
        (1, "OP-1", "Person1"), (2, "OP-2", "Rep2"), (8, None, "Person1")]


def test_extracts_without_unwanted_attributes_make_the_same_groups(spark):
    """Products, customers and parties that differ only in attributes that an extract drops
    stay apart, equal ones are summed, and duplicate records still multiply rows."""
    names = "cust_account_id long, account_name string, account_number string"
    extra = dict(
        products=([(1, "P1", "EB", None, "T1"), (2, "P1", "EB", None, "T1"), (3, "P1", "EB", None, "T2"), (4, "P1", "EB", "EN", "T1"),
                   (4, "P1", "EB", "DE", "T1"), (5, "P2", None, None, None), (6, "P2", None, None, None),
                   (7, "P3", "EB", None, "T1"), (7, "P3", "EB", None, "T2"), (8, "P3", "EB", None, "T2")],
                  "inventory_item_id long, product_number string, format string, language string, title_abbreviation string"),
        parties=([(7, "Party7", "RG7"), (8, "Party8", "RG8"), (8, "Other8", "RG8"), (8, "Other8", "RG8")],
                 "party_id long, party_name string, party_number string"),
        customers_bill_to=([(7, "Acct7", "AC7", "RG0", "Parent0"), (7, "Acct7", "AC7", "RG0", None), (8, None, None, None, None)],
                           names + ", parent_number string, parent_name string"),
        customers_sold_to=([(7, "Acct7", "AC7"), (7, "Acct7", None), (7, "Acct7", "AC7")], names))
    detail = [(h, 10 * h + i, h, "N", 20200101 + i % 2, item, party, bill, sold, 1, _dec(1), _dec(10 + i), _dec(5))
              for i, (h, item, party, bill, sold) in enumerate(
                  (h, item, party, bill, sold) for h in (1, 2) for item in range(1, 9) for party in (7, 8, 9, None)
                  for bill in (7, 8, None) for sold in (7, 8))]
    cat = _base(spark, detail, extra)
    cfg = ForecastConfig(contract_min_period=202001, contract_max_period=202012, contract_excluded_products=())
    whole = O.contracted_tcv_fact(cat, cfg)
    narrow = O.contracted_tcv_fact(cat, cfg, wanted=O.K.TCV_EXTRACT_COLUMNS)
    assert "TITLE_ABBREVIATION" not in narrow.columns
    got = rows(narrow, *O.K.TCV_EXTRACT_COLUMNS)
    assert len(got) > 100 and got == rows(whole, *O.K.TCV_EXTRACT_COLUMNS)
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    grouping = next(x for x in plan.splitlines() if "HashAggregate(keys=[PRODUCT_NUMBER" in x)
    assert "SOLD_TO_ACCOUNT_NAME" not in grouping and "PARTY_NAME" not in grouping


def test_contracted_value_is_shuffled_twice_where_dimensions_are_small(spark, tmp_path):
    """Rows are summed where the headers' join has put them, and grouped at last where they
    were put before the attributes: several headers of an order are one row."""
    detail = [(1, 11, h, "N", 20200102, 1, 7, 7, 7, 1, None, _dec(10), _dec(h)) for h in (1, 2, 2)]
    cat = _base(spark, detail)
    for n in ("products", "parties", "customers_bill_to", "customers_sold_to"):  # files have a size
        cat[n].write.parquet(f"{tmp_path}/{n}")
        cat[n] = spark.read.parquet(f"{tmp_path}/{n}")
    out = O.contracted_tcv_fact(cat, ForecastConfig(contract_min_period=None, contract_max_period=None))
    assert rows(out, "Amount", "ORDER_HEADER_ID") == [(_dec("35.00"), 1)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(order_header_id" in plan and "hashpartitioning(PRODUCT_NUMBER" not in plan
