"""The driver-table role mapping restated in SQL (DuckDB dialect).

Each entry is one CTE body; ``with_roles`` prepends the CTEs a query needs
(with their dependencies, in order). It is an independent restatement of
``revcast.sources.driver_tables`` used by the oracle queries; the two are
kept in step by the correctness check.
"""

from __future__ import annotations

import re

YMD = "CAST(year({d})*10000 + month({d})*100 + day({d}) AS BIGINT)"
FP = "CAST(year(CAST({d} AS DATE) + INTERVAL 6 MONTH)*100 + month(CAST({d} AS DATE) + INTERVAL 6 MONTH) AS INTEGER)"
MONEY = "CAST({x} AS DECIMAL(18,2))"
AS_OF = "TIMESTAMP '1999-06-30 12:00:00'"
AS_OF_DATE = "DATE '1999-06-30'"


def ymd(d: str) -> str:
    return YMD.format(d=d)


def fp(d: str) -> str:
    return FP.format(d=d)


def money(x: str) -> str:
    return MONEY.format(x=x)


def pkey(num: str, fmt: str, lang: str) -> str:
    return f"COALESCE({num},'') || '-' || COALESCE({fmt},'') || '-' || COALESCE({lang},'')"


def fy(p: str) -> str:
    return f"'FY' || substr(CAST(CAST({p} AS INTEGER) AS VARCHAR), 3, 2)"


FMT = "CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_type END"
LANG = "CASE WHEN p_size % 3 = 0 THEN 'EN' WHEN p_size % 3 = 1 THEN 'DE' END"
OPP_NUM = "CASE WHEN o_orderkey IN (7, 8) THEN NULL ELSE 'OP-' || o_orderkey END"

ROLES: dict[str, str] = {
    "lines": "SELECT l.*, o.o_custkey FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey",
    "lines_orders": "SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "transactions": f"""
        SELECT {AS_OF_DATE} AS Today__c,
          'TX' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS Id,
          CAST(l_orderkey + 1000000 AS VARCHAR) AS Order_Number__c,
          CAST(date_trunc('month', l_shipdate) AS DATE) AS Transaction_Month__c,
          CASE WHEN l_linestatus = 'O' THEN 'Opportunity Schedule'
               WHEN l_returnflag = 'R' THEN 'Manual - SD' ELSE 'Invoice' END AS Transaction_Type__c,
          CASE WHEN o_custkey % 10 = 9 THEN NULL ELSE 'ACC' || o_custkey END AS Account__c,
          {pkey('p_brand', FMT, LANG)} AS Product_Number__c,
          CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE p_name END AS Offering__c,
          'Item ' || l_partkey AS Product__c,
          'OPP' || l_orderkey AS Opportunity__c,
          CASE WHEN l_quantity <= 2 THEN NULL WHEN l_quantity = 3 THEN CAST(0 AS DECIMAL(18,2))
               ELSE {money('l_extendedprice')} END AS Transaction_Amount__c,
          CASE WHEN l_returnflag = 'R' THEN 'PRJ' || l_orderkey END AS Project__c,
          CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS Project_Flag__c,
          CASE WHEN l_returnflag = 'R' OR l_orderkey % 3 = 0 THEN 'MS' || l_orderkey END AS Milestone__c
        FROM lines JOIN part ON l_partkey = p_partkey""",
    "pipeline_detail": f"""
        SELECT l_orderkey AS order_header_id, l_orderkey*10 + l_linenumber AS order_line_id,
          l_orderkey AS pipeline_header_id, l_returnflag AS pipeline_source,
          {ymd('l_shipdate')} AS transaction_date_key, l_partkey AS inventory_item_id,
          o_custkey AS bill_to_party_id, o_custkey AS bill_to_customer_id,
          o_custkey AS sold_to_customer_id, l_suppkey AS resource_id,
          {money('l_extendedprice')} AS future_billing_amount,
          CASE WHEN l_quantity <= 2 THEN NULL WHEN l_linestatus = 'O' THEN {money('l_extendedprice')}
               ELSE CAST(0 AS DECIMAL(18,2)) END AS open_order_amount,
          CASE WHEN l_quantity <= 2 THEN NULL WHEN l_linestatus = 'F' THEN {money('l_extendedprice')}
               ELSE CAST(0 AS DECIMAL(18,2)) END AS closed_order_amount
        FROM lines""",
    "sales_detail": f"""
        SELECT l_orderkey AS order_header_id, l_suppkey % 4 AS code_combination_id,
          {ymd('l_shipdate')} AS gl_date_key, l_partkey AS inventory_item_id,
          o_custkey AS bill_to_party_id, o_custkey AS bill_to_customer_id,
          o_custkey AS sold_to_customer_id, l_suppkey AS salesrep_id,
          {money('l_extendedprice')} AS line_amount
        FROM lines""",
    "dim_dates": f"""
        SELECT {ymd('date_field')} AS date_key, date_field, {fp('date_field')} AS fiscal_yyyymm
        FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date_field FROM lineitem)""",
    "products": f"""
        SELECT p_partkey AS inventory_item_id, p_brand AS product_number, {FMT} AS format,
          {LANG} AS language, p_name AS title_abbreviation FROM part""",
    "pipeline_sources": """
        SELECT l_returnflag AS pipeline_source,
          CASE l_returnflag WHEN 'A' THEN 'Future Billing' WHEN 'N' THEN 'Open Order'
                            WHEN 'R' THEN 'Closed Order' END AS description
        FROM (SELECT DISTINCT l_returnflag FROM lineitem)""",
    "parties": "SELECT c_custkey AS party_id, c_name AS party_name, 'RG' || c_custkey AS party_number FROM customer",
    "customers_bill_to": """
        SELECT c_custkey AS cust_account_id, c_name AS account_name, 'AC' || c_custkey AS account_number,
          'RG' || (c_custkey - c_custkey % 10) AS parent_number,
          'Parent ' || (c_custkey - c_custkey % 10) AS parent_name FROM customer""",
    "customers_sold_to": """
        SELECT c_custkey AS cust_account_id, c_name AS account_name, 'AC' || c_custkey AS account_number
        FROM customer""",
    "pipeline_order_lines": """
        SELECT order_line_id,
          CASE WHEN order_line_id % 7 = 0 THEN 'BLP Ratable' WHEN order_line_id % 7 = 1 THEN 'DEFERRED-OPEN'
               WHEN order_line_id % 7 = 2 THEN NULL ELSE 'Standard' END AS accounting_rule,
          CASE WHEN order_line_id % 5 = 0 THEN NULL WHEN order_line_id % 5 = 1 THEN 'N' ELSE 'Y' END AS po_hold
        FROM (SELECT DISTINCT l_orderkey*10 + l_linenumber AS order_line_id FROM lineitem)""",
    "pipeline_resources": "SELECT s_suppkey AS resource_id, s_name AS resource_name FROM supplier",
    "pipeline_headers": """
        SELECT pipeline_header_id, pipeline_source,
          CASE WHEN pipeline_header_id % 9 = 0 THEN '9' || pipeline_header_id
               WHEN pipeline_header_id % 9 = 1 THEN NULL ELSE 'T' || pipeline_header_id END AS transaction_no
        FROM (SELECT DISTINCT l_orderkey AS pipeline_header_id, l_returnflag AS pipeline_source FROM lineitem)""",
    "gl_code_combos": """
        SELECT code_combination_id, s1 AS segment1, 'Company ' || s1 AS segment1_desc,
          s2 AS segment2, 'Account ' || s2 AS segment2_desc
        FROM (SELECT code_combination_id,
                CASE WHEN code_combination_id < 2 THEN '01' ELSE '02' END AS s1,
                CASE WHEN code_combination_id % 2 = 0 THEN '610' ELSE '620' END AS s2
              FROM (SELECT DISTINCT l_suppkey % 4 AS code_combination_id FROM lineitem))""",
    "salesreps": "SELECT s_suppkey AS salesrep_id, s_name AS salesrep_name FROM supplier",
    "order_headers": """
        SELECT o_orderkey AS header_id, o_orderkey + 1000000 AS order_number,
          CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 29 = 0 THEN '   '
               WHEN o_orderkey % 5 = 0 THEN ' ' || chr(9) || 'OP-' || o_orderkey || '  '
               ELSE 'OP-' || o_orderkey END AS attribute11,
          o_custkey % 10 AS salesrep_id, o_custkey AS invoice_to_org_id
        FROM orders""",
    "rep_groups": """
        SELECT group_id, CASE WHEN group_id % 4 = 0 THEN 'XX Group ' || group_id
                              ELSE 'CL Group ' || group_id END AS group_name
        FROM (SELECT DISTINCT s_nationkey AS group_id FROM supplier)""",
    "group_members": """
        SELECT s_nationkey AS group_id, s_suppkey AS resource_id,
          CASE WHEN s_suppkey % 7 = 3 THEN 'Y' ELSE 'N' END AS delete_flag FROM supplier""",
    "reps": """
        SELECT s_suppkey AS resource_id, s_suppkey AS salesrep_id, s_suppkey AS person_id,
          CASE WHEN s_suppkey % 4 = 1 THEN NULL ELSE 'Rep ' || s_suppkey END AS name FROM supplier""",
    "people": """
        SELECT s_suppkey AS person_id, s_name AS full_name,
          CASE WHEN s_suppkey % 6 = 5 THEN DATE '1999-07-15' ELSE DATE '1990-01-01' END AS effective_start_date,
          CASE WHEN s_suppkey % 6 IN (0, 5) THEN NULL WHEN s_suppkey % 6 = 2 THEN DATE '1999-06-30'
               WHEN s_suppkey % 6 = 3 THEN DATE '1998-01-01' ELSE DATE '2005-01-01' END AS effective_end_date
        FROM supplier""",
    "order_lines": """
        SELECT line_id, line_id // 10 AS header_id, 'IT' || item AS ordered_item, item AS inventory_item_id
        FROM (SELECT l_orderkey*10 + l_linenumber AS line_id, min(l_partkey) AS item
              FROM lineitem GROUP BY 1)""",
    "item_master": """
        SELECT p_partkey AS inventory_item_id, CASE WHEN p_partkey % 10 = 0 THEN 84 ELSE 83 END AS organization_id
        FROM part""",
    "cust_accounts": """
        SELECT c_custkey AS cust_account_id, 'AC' || c_custkey AS account_number, c_name AS account_name
        FROM customer""",
    "acct_sites": "SELECT c_custkey AS cust_acct_site_id, c_custkey AS cust_account_id FROM customer",
    "site_uses": "SELECT c_custkey AS site_use_id, c_custkey AS cust_acct_site_id FROM customer",
    "order_holds": """
        SELECT line_id, line_id % 3 AS hold_source_id,
          CASE WHEN line_id % 4 = 0 THEN line_id END AS hold_release_id
        FROM (SELECT DISTINCT l_orderkey*10 + l_linenumber AS line_id FROM lineitem)""",
    "hold_sources": """
        SELECT k AS hold_source_id, k AS hold_id, DATE '2002-01-01' + CAST(k AS INTEGER) AS hold_until_date
        FROM (SELECT DISTINCT (l_orderkey*10 + l_linenumber) % 3 AS k FROM lineitem)""",
    "hold_definitions": """
        SELECT k AS hold_id, CASE WHEN k = 1 THEN 'Credit Hold' ELSE 'Multi-Year Contract Hold' END AS name
        FROM (SELECT DISTINCT (l_orderkey*10 + l_linenumber) % 3 AS k FROM lineitem)""",
    # CRM objects, prefixed as the pipeline reads them.
    "trx": """
        SELECT Today__c AS Trx_Today__c, Id AS Trx_Id, Order_Number__c AS Trx_Order_Number__c,
          Transaction_Month__c AS Trx_Transaction_Month__c, Transaction_Type__c AS Trx_Transaction_Type__c,
          Account__c AS Trx_Account__c, Product_Number__c AS Trx_Product_Number__c,
          Offering__c AS Trx_Offering__c, Opportunity__c AS Trx_Opportunity__c,
          Transaction_Amount__c AS Trx_Transaction_Amount__c, Project__c AS Trx_Project__c,
          Project_Flag__c AS Trx_Project_Flag__c, Milestone__c AS Trx_Milestone__c
        FROM transactions WHERE Transaction_Type__c IN ('Opportunity Schedule', 'Manual - SD')""",
    "acct": """
        SELECT 'ACC' || c_custkey AS Acct_Id,
          CASE WHEN c_custkey % 10 = 3 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS Acct_Party_ID__c,
          'USR' || (c_custkey % 10) AS Acct_OwnerId, c_name AS Acct_Name,
          'R' || c_nationkey AS Acct_Region__c, r_name AS Acct_Sales_Region_text__c
        FROM customer LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey)
          ON c_nationkey = n_nationkey""",
    "usr": "SELECT 'USR' || s_suppkey AS User_Id, s_name AS User_Name FROM supplier",
    "opps_raw": f"""
        SELECT 'OPP' || o_orderkey AS Opps_Id, {OPP_NUM} AS Opps_Opportunity__c,
          CAST(date_trunc('month', CAST(o_orderdate AS DATE) + 45) AS DATE) AS Opps_Month_Close__c,
          CAST(o_orderdate AS DATE) + 30 AS Opps_CloseDate,
          CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST((o_orderkey % 11) * 10 AS DOUBLE) END AS Opps_Probability,
          CASE WHEN o_orderstatus = 'F' THEN 'Closed Won' WHEN o_orderstatus = 'O' THEN 'Negotiation'
               ELSE 'Proposal' END AS Opps_StageName,
          CASE WHEN o_orderkey % 2 = 0 THEN 'New' ELSE 'Renewal' END AS Opps_Type,
          {money('o_totalprice')} AS Opps_Amount,
          'LNK' || (o_orderkey % 10) AS Opps_Owner_Link__c, 'USR' || (o_orderkey % 10) AS Opps_OwnerId
        FROM orders""",
    "opps_ref": f"""
        SELECT Opps_Id, Opps_Opportunity__c, {fp('Opps_Month_Close__c')} AS Opps_Month_Close__c,
          Opps_CloseDate, Opps_Probability, Opps_StageName, Opps_Type, Opps_Amount,
          Opps_Owner_Link__c, Opps_OwnerId
        FROM opps_raw""",
    "opps_acct": f"""
        SELECT {OPP_NUM} AS OppsAcct_Opportunity__c,
          CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE 'ACC' || o_custkey END AS OppsAcct_Account
        FROM orders""",
    "prnt": """
        SELECT 'ACC' || (c_custkey - c_custkey % 10) AS Prnt_Id,
          CASE WHEN c_custkey % 9 = 4 THEN NULL ELSE 'RG' || c_custkey END AS Prnt_Registry_ID__c
        FROM customer""",
    "proj": """
        SELECT 'PRJ' || o_orderkey AS Proj_Id, 'Project ' || o_orderkey AS Proj_Name,
          'PN' || o_orderkey AS Proj_Project_Number__c,
          CASE o_orderkey % 8 WHEN 0 THEN 'Scheduled' WHEN 1 THEN 'Unscheduled' WHEN 2 THEN 'Soft Scheduled'
            WHEN 3 THEN 'Project Initiated' WHEN 4 THEN 'Closed' WHEN 5 THEN 'Canceled'
            WHEN 6 THEN 'On Hold' END AS Proj_pse__Stage__c
        FROM orders""",
    "mile": """
        SELECT 'MS' || o_orderkey AS Mile_Id, 'Milestone ' || o_orderkey AS Mile_Name,
          CASE o_orderkey % 4 WHEN 0 THEN '012E0000000fBNOIA2' WHEN 1 THEN '012E0000000fBNPIA2'
            WHEN 2 THEN '0120L000000NQCGQA4' ELSE 'RT-OTHER' END AS Mile_RecordTypeId,
          CAST(o_orderdate AS DATE) + 60 AS Mile_pse__Target_Date__c,
          CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE) + 75 END AS Mile_pse__Actual_Date__c,
          CASE WHEN o_orderstatus = 'F' THEN 'Complete' ELSE 'Open' END AS Mile_pse__Status__c,
          CASE WHEN o_orderkey % 3 = 0 THEN 'OL' || o_orderkey END AS Mile_Opportunity_Line_Item_Id__c,
          CASE WHEN o_orderkey % 4 <> 3 THEN 'ORD' || o_orderkey END AS Mile_Order__c,
          'USR' || (o_orderkey % 7) AS Mile_Engagement_Manager__c,
          'USR' || (o_orderkey % 5) AS Mile_Psa_Group_Owner__c,
          CAST((o_orderkey % 5) * 20 AS DOUBLE) AS Mile_Probability__c
        FROM orders""",
    "ordr": """
        SELECT 'ORD' || o_orderkey AS Order_Id, 'SO-' || o_orderkey AS Order_Name,
          'OP-' || o_orderkey AS Order_Opportunity_Number__c, 'OPP' || o_orderkey AS Order_Opportunity__c
        FROM orders""",
    "oppline": """
        SELECT 'OL' || o_orderkey AS Oppline_Id, 'Line ' || o_orderkey AS Oppline_Name,
          'OPP' || (o_orderkey + 1) AS Oppline_OpportunityId FROM orders""",
    "offr_raw": """
        SELECT Offering__c AS Offr_Offering__c, Product_Number__c AS Offr_Product_Number__c,
          Product__c AS Offr_Product__c, Transaction_Month__c AS Offr_Transaction_Month__c
        FROM transactions""",
    "offr": """
        SELECT Offr_Product_Number__c, Offr_Offering__c FROM (
          SELECT *, row_number() OVER (PARTITION BY Offr_Product_Number__c
                 ORDER BY Offr_Transaction_Month__c DESC NULLS LAST, Offr_Offering__c ASC NULLS FIRST) AS rn
          FROM offr_raw WHERE Offr_Product_Number__c IS NOT NULL) WHERE rn = 1""",
    "billparty": """
        SELECT Acct_Id, CAST(Acct_Party_ID__c AS BIGINT) AS Acct_Party_ID__c, Acct_OwnerId, Acct_Name,
          Acct_Region__c, Acct_Sales_Region_text__c
        FROM acct WHERE Acct_Party_ID__c IS NOT NULL""",
    "prnt_ref": "SELECT * FROM prnt WHERE Prnt_Registry_ID__c IS NOT NULL",
}


def with_roles(body: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` clause of the role CTEs (and ``extra`` CTEs, in order)
    that ``body`` refers to, followed by ``body``."""
    extra = extra or {}
    ordered: list[str] = []

    def visit(name: str, text: str):
        for k in ROLES:
            if k != name and k not in ordered and re.search(rf"\b{k}\b", text):
                visit(k, ROLES[k])
                if k not in ordered:
                    ordered.append(k)

    texts = [body] + list(extra.values())
    for t in texts:
        visit("", t)
    parts = [f"{k} AS ({ROLES[k]})" for k in ordered]
    parts += [f"{k} AS ({v})" for k, v in extra.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
