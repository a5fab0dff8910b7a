"""Schemas of the order-system base tables and the CRM objects (FIXTURES.md),
for input that carries none (CSV)."""

from __future__ import annotations

from pyspark.sql.types import StructType

ORDER_TABLES = {
    "pipeline_detail": "order_header_id bigint, order_line_id bigint, pipeline_header_id bigint, "
                       "pipeline_source string, transaction_date_key bigint, inventory_item_id bigint, "
                       "bill_to_party_id bigint, bill_to_customer_id bigint, sold_to_customer_id bigint, "
                       "resource_id bigint, future_billing_amount decimal(18,2), open_order_amount decimal(18,2), "
                       "closed_order_amount decimal(18,2)",
    "sales_detail": "order_header_id bigint, code_combination_id bigint, gl_date_key bigint, "
                    "inventory_item_id bigint, bill_to_party_id bigint, bill_to_customer_id bigint, "
                    "sold_to_customer_id bigint, salesrep_id bigint, line_amount decimal(18,2)",
    "dim_dates": "date_key bigint, date_field date, fiscal_yyyymm int",
    "products": "inventory_item_id bigint, product_number string, format string, language string, "
                "title_abbreviation string",
    "pipeline_sources": "pipeline_source string, description string",
    "parties": "party_id bigint, party_name string, party_number string",
    "customers_bill_to": "cust_account_id bigint, account_name string, account_number string, "
                         "parent_number string, parent_name string",
    "customers_sold_to": "cust_account_id bigint, account_name string, account_number string",
    "pipeline_order_lines": "order_line_id bigint, accounting_rule string, po_hold string",
    "pipeline_resources": "resource_id bigint, resource_name string",
    "pipeline_headers": "pipeline_header_id bigint, pipeline_source string, transaction_no string",
    "gl_code_combos": "code_combination_id bigint, segment1 string, segment1_desc string, segment2 string, "
                      "segment2_desc string",
    "salesreps": "salesrep_id bigint, salesrep_name string",
    "order_headers": "header_id bigint, order_number bigint, attribute11 string, salesrep_id bigint, "
                     "invoice_to_org_id bigint",
    "rep_groups": "group_id int, group_name string",
    "group_members": "group_id int, resource_id bigint, delete_flag string",
    "reps": "resource_id bigint, salesrep_id bigint, person_id bigint, name string",
    "people": "person_id bigint, full_name string, effective_start_date date, effective_end_date date",
    "order_lines": "line_id bigint, header_id bigint, ordered_item string, inventory_item_id bigint",
    "item_master": "inventory_item_id bigint, organization_id int",
    "cust_accounts": "cust_account_id bigint, account_number string, account_name string",
    "acct_sites": "cust_acct_site_id bigint, cust_account_id bigint",
    "site_uses": "site_use_id bigint, cust_acct_site_id bigint",
    "order_holds": "line_id bigint, hold_source_id bigint, hold_release_id bigint",
    "hold_sources": "hold_source_id bigint, hold_id bigint, hold_until_date date",
    "hold_definitions": "hold_id bigint, name string",
    "zero_party_dates": "party_id bigint, date_field date",
    "zero_orders": "order_header_id bigint",
    "zero_rules": "party_id bigint, date_field date, order_header_id bigint",
}

# A CRM record's nested parent is its id in a flat file.
CRM_OBJECTS = {
    "Fact_Trx": "Today__c date, Id string, Order_Number__c string, Transaction_Month__c date, "
                "Transaction_Type__c string, Account__c string, Product_Number__c string, Offering__c string, "
                "Product__c string, Opportunity__c string, Transaction_Amount__c decimal(18,2), Project__c string, "
                "Project_Flag__c string, Milestone__c string",
    "Ref_Acct": "Id string, Party_ID__c string, OwnerId string, Name string, Region__c string, "
                "Sales_Region_text__c string",
    "Ref_Mile": "Id string, Name string, RecordTypeId string, pse__Target_Date__c date, "
                "pse__Actual_Date__c date, pse__Status__c string, Opportunity_Line_Item_Id__c string, "
                "Order__c string, Engagement_Manager__c string, Psa_Group_Owner__c string, Probability__c double",
    "Ref_Opps": "Id string, Opportunity__c string, Month_Close__c date, CloseDate date, Probability double, "
                "StageName string, Type string, Amount decimal(18,2), Owner_Link__c string, OwnerId string",
    "Ref_Proj": "Id string, Name string, Project_Number__c string, pse__Stage__c string",
    "Ref_User": "Id string, Name string",
    "Ref_Prnt": "Id string, Registry_ID__c string",
    "Ref_Offr": "Offering__c string, Product_Number__c string, Product__c string, Transaction_Month__c date",
    "Ref_Order": "Id string, Name string, Opportunity_Number__c string, Opportunity__c string",
    "Ref_Oppline": "Id string, Name string, OpportunityId string",
    "Ref_Opps_Acct": "Opportunity__c string, Account string",
}


def order_schemas() -> dict[str, StructType]:
    return {n: StructType.fromDDL(d) for n, d in ORDER_TABLES.items()}


def crm_schemas() -> dict[str, StructType]:
    return {n: StructType.fromDDL(d) for n, d in CRM_OBJECTS.items()}
