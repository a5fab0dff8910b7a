"""Business constants of the forecast pipelines.

Everything in the block below is a FIXED VALUE: it has to equal what the
original pipeline uses, or the forecasts come out different. The values are
listed plainly and in their natural order. Three entries differ on purpose
and say so: the prefix of the opportunity-account object, the order number
among the hold columns, and the opportunity's close date. Person-linked ids (excluded
representatives, zero-out parties) are not fixed values: callers pass them
as rule tables.
"""

# --- FIXED VALUES (must match the original pipeline) -----------------------

# Project stage -> short code (anything else, null included, -> "NA").
PROJECT_STAGE_CODES = {
    "Scheduled": "Schl",
    "Unscheduled": "UnSchl",
    "Soft Scheduled": "SoftSchl",
    "Project Initiated": "ProjInit",
    "Closed": "Closed",
    "Canceled": "Canceled",
}
PROJECT_STAGE_DEFAULT = "NA"

# Revenue type id (as text) -> revenue code. "Manual - SD" takes the mapped
# project stage instead; anything else -> "unmapped".
REVENUE_TYPE_CODES = {
    "1": "RecRev",
    "2": "DefRev",
    "3": "BillEv",
    "Opportunity Schedule": "PipeLn",
    "PO Hold": "POH",
}
REVENUE_TYPE_FROM_STAGE = "Manual - SD"
REVENUE_TYPE_DEFAULT = "unmapped"
PIPELINE_CODE = "PipeLn"

# Inclusion flag: legacy periods count recognised revenue only; new periods
# count these codes.
LAST_LEGACY_PERIOD = 201712
FIRST_NEW_PERIOD = 201801
NEW_PERIOD_CODES = ("RecRev", "BillEv", "DefRev", "Schl")

# Forecast exclusions (kept when null, like the original's pandas filters).
TEST_ACCOUNTS = ("HD Test", "CL Training & Test", "Astadia Test Account")
EXCLUDED_FISCAL_YEARS = ("FY12", "FY13")

# Milestone record-type id -> name (anything else passes through).
MILESTONE_RECORD_TYPES = {
    "012E0000000fBNOIA2": "Delivery",
    "012E0000000fBNPIA2": "Revenue",
    "0120L000000NQCGQA4": "Task",
}

# CRM transaction types read by the transaction extract, and the one that
# makes up the pipeline.
CRM_TRANSACTION_TYPES = ("Opportunity Schedule", "Manual - SD")
PIPELINE_TRANSACTION_TYPE = "Opportunity Schedule"

# Order-side extracts.
BILLING_SOURCES = ("Future Billing",)
CONTRACT_SOURCES = ("Open Order", "Closed Order")
BILLING_EXCLUDED_PRODUCTS = ("ULV11", "ULV11A")
BILLING_EXCLUDED_ACCOUNTING_RULES = ("BLP Ratable", "DEFERRED-OPEN")
CONTRACT_EXCLUDED_PRODUCTS = ("3002S9", "HBSXED", "HBX")
PRO_FORMA_PREFIX = "9"
BILLING_MIN_PERIOD = 201601
LEDGER_MIN_PERIOD = 201401
LEDGER_MAX_PERIOD = 205001
LEDGER_SEGMENT1 = "01"
LEDGER_SEGMENT2 = "610"
RECOGNISED_TYPE = 1
DEFERRED_TYPE = 2
BILLING_TYPE = 3
CONTRACT_TYPE = 7
HOLD_NAME = "Multi-Year Contract Hold"
HOLD_FLAG = "Y"
HOLD_CATEGORY = "PO Hold"
HOLD_ORGANIZATION_ID = 83
REP_GROUP_PREFIX = "CL"
OPPORTUNITY_ID_OVERRIDES = {"ClOpp-26209": "CLOpp-26209"}

# Forecast source tags.
SRC_ACTUAL = "actual"
SRC_PIPELINE = "unw_pl"
SRC_UNREPORTED = "sf_non_tcv"

# CRM transaction fact: column renames after the join chain (output order).
CRM_FINAL_COLUMNS = {
    "Trx_Order_Number__c": "Trx_OrderNum",
    "Trx_Transaction_Month__c": "Trx_Month",
    "Trx_Transaction_Type__c": "Trx_Type",
    "Trx_Product_Number__c": "Trx_ProdNum",
    "Trx_Offering__c": "Trx_Offering",
    "Trx_Transaction_Amount__c": "Trx_Amount",
    "Acct_Region__c": "Acct_RegionDan",
    "Acct_Sales_Region_text__c": "Acct_RegionHunter",
    "Acct_Name": "Acct_Name",
    "User_Name": "Acct_Owner",
    "User_Name_Opps": "Opp_Owner",
    "Opps_Opportunity__c": "Opp_Num",
    "Opps_Month_Close__c": "Opp_CloseMonth",
    "Opps_CloseDate": "Opp_CloseDate",
    "Opps_Probability": "Opp_Prob",
    "Opps_StageName": "Opp_Stage",
    "Opps_Type": "Opp_Type",
    "Opps_Amount": "Opps_Amount",
    "Proj_Project_Number__c": "Proj_Num",
    "Proj_pse__Stage__c": "Proj_Stage",
    "Mile_Id": "Mile_Id",
    "Mile_Name": "Mile_Name",
    "Mile_RecordTypeId": "Mile_Type",
    "Mile_pse__Target_Date__c": "Mile_TargetDate",
    "Mile_pse__Actual_Date__c": "Mile_ActualDate",
    "Mile_pse__Status__c": "Mile_Status",
    "Mile_Order__c": "Mile_Order",
    "Mile_Probability__c": "Mile_Prob",
    "Mile_Engagement_Manager__c": "Mile_EnageManager",
    "Order_Name": "Order_Name",
    "Order_Opportunity_Number__c": "Order_Opp",
    "Opps_Opportunity__c_MileOpp": "MileOppLine_OppNum",
    "Opps_Month_Close__c_MileOpp": "MileOppLine_MonthClose",
    "Opps_Probability_MileOpp": "MileOppLine_OppProb",
    "Opps_StageName_MileOpp": "MileOppLine_OppStage",
    "Opps_Type_MileOpp": "MileOppLine_OppType",
    "Opps_Amount_MileOpp": "MileOppLine_OppAmount",
}

# Forecast inputs: column renames shared by order and CRM facts (keys in
# order; several keys share a target, the first present one wins).
FORECAST_COLUMNS = {
    "PRODUCT_NUMBER_CONCAT": "ProdNum",
    "FISCAL_YYYYMM": "revFYFP",
    "Transaction Date": "revdate",
    "Revenue Type ID": "RevID",
    "Amount": "Amount",
    "ORDER_NUMBER_y": "OrderNum",
    "ORDER_NUMBER": "OrderNum",
    "OppsAcct_Opportunity__c": "Opp_Num",
    "Acct_Sales_Region_text__c_Final": "Region",
    "User_Name": "AcctOwner",
    "Opps_Month_Close__c": "Opp_CloseMonth",
    "Opps_CloseDate": "Opp_CloseDate",  # differs: the original's name lacks the prefix and never matches
    "Opps_Probability": "Opp_Prob",
    "Opps_StageName": "Opp_Stage",
    "Opps_Type": "Opp_Type",
    "Opps_Amount": "Opps_UnWAmount",
    "Acct_Name_Final": "Account",
    "Trx_OrderNum": "OrderNum",
    "Trx_Month": "revFYFP",
    "Trx_Type": "RevID",
    "Trx_ProdNum": "ProdNum",
    "Trx_Offering": "Offering",
    "Trx_Amount": "Amount",
    "Acct_RegionHunter": "Region",
    "Acct_Name": "Account",
    "Acct_Owner": "AcctOwner",
    "Opp_Owner": "OppOwner",
    "User_Name_x": "AcctOwner",
    "User_Name_Opps": "OppOwner",
    "Opp_Num": "Opp_Num",
    "Opp_CloseMonth": "Opp_CloseMonth",
    "Opp_CloseDate": "Opp_CloseDate",
    "Opp_Prob": "Opp_Prob",
    "Opp_Stage": "Opp_Stage",
    "Opp_Type": "Opp_Type",
    "Proj_Num": "Proj_Num",
    "Proj_Stage": "Proj_Stage",
    "Mile_Name": "Mile_Name",
    "Mile_Id": "Mile_Id",
    "Mile_Type": "Mile_Type",
    "Mile_TargetDate": "Mile_TargetDate",
    "Mile_ActualDate": "Mile_ActualDate",
    "Mile_Status": "Mile_Status",
    "Mile_Prob": "Mile_Prob",
    "Offr_Offering__c": "Offering",
    "Mile_EnageManager": "Mile_EnageManager",
    "TCV_UnWPL": "TCV_UnWPL",
    "ebs_rep": "ebs_rep",
}

# Opportunities reported in neither fact: renames into the TCV forecast.
UNREPORTED_RENAMES = {
    "Opps_Opportunity__c": "Opp_Num",
    "Opps_Month_Close__c": "Opp_CloseMonth",
    "Opps_CloseDate": "Opp_CloseDate",
    "Opps_Probability": "Opp_Prob",
    "Opps_StageName": "Opp_Stage",
    "Opps_Type": "Opp_Type",
    "Opps_Amount": "unw_non_tcv",
}

# Hold extract renames (raw name -> forecast name).
HOLD_COLUMNS = {
    "PRODUCT": "PRODUCT_NUMBER_CONCAT",
    "BILL_TO_PARTY": "BILL_TO_PARTY_ID",
    "BILLING_EVENT_DATE": "FISCAL_YYYYMM",
    "FORECAST_CATEGORY": "Revenue Type ID",
    "ORDER_NUMBER": "ORDER_NUMBER",
    "NET_AMOUNT": "Amount",
    "ORDER_HEADER_ID": "ORDER_HEADER_ID",
}

# Columns each order-side extract keeps.
TCV_EXTRACT_COLUMNS = (
    "PRODUCT_NUMBER_CONCAT", "BILL_TO_PARTY_ID", "PARTYNUMBER_AKA_REGISTRYID",
    "FISCAL_YYYYMM", "Amount", "ORDER_HEADER_ID", "BILL_TO_ACCOUNT_NAME",
    "BILL_TO_ACCOUNT_NUMBER", "PRODUCT_NUMBER", "ebs_rep",
)
BILLING_EXTRACT_COLUMNS = (
    "PRODUCT_NUMBER_CONCAT", "BILL_TO_PARTY_ID", "PARTYNUMBER_AKA_REGISTRYID",
    "FISCAL_YYYYMM", "Revenue Type ID", "ORDER_HEADER_ID", "Amount", "ebs_rep",
)
LEDGER_EXTRACT_COLUMNS = (
    "PRODUCT_NUMBER_CONCAT", "BILL_TO_PARTY_ID", "PARTYNUMBER_AKA_REGISTRYID",
    "FISCAL_YYYYMM", "Transaction Date", "Revenue Type ID", "ORDER_HEADER_ID",
    "Amount", "ebs_rep",
)
ORDER_MAP_EXTRACT_COLUMNS = ("ORDER_HEADER_ID", "OPPORTUNITY_ID", "ORDER_NUMBER")
HOLD_EXTRACT_COLUMNS = (
    "PRODUCT", "BILL_TO_PARTY", "BILLING_EVENT_DATE", "FORECAST_CATEGORY",
    "ORDER_NUMBER", "NET_AMOUNT", "SALESREP_ID",
)

# Pipeline TCV: opportunity attributes re-attached to the pipeline totals.
PIPELINE_REF_FIELDS = (
    "Opp_Num", "Opp_Stage", "Opp_Type", "Opp_CloseMonth", "Opp_Prob",
    "Opps_Amount", "Acct_Name", "Acct_Owner", "Opp_Owner", "Acct_RegionHunter",
)

# CRM object prefixes.
CRM_PREFIXES = {
    "Fact_Trx": "Trx_",
    "Ref_Acct": "Acct_",
    "Ref_Mile": "Mile_",
    "Ref_Opps": "Opps_",
    "Ref_Proj": "Proj_",
    "Ref_User": "User_",
    "Ref_Prnt": "Prnt_",
    "Ref_Offr": "Offr_",
    "Ref_Order": "Order_",
    "Ref_Oppline": "Oppline_",
}

# --- end of fixed values ----------------------------------------------------
