"""CRM-side pieces on hand-made rows (FIXTURES.md section 4)."""

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from revcast.plans import crm

from conftest import rows

FACT = ("Trx_Type string, Opp_Num string, Trx_Offering string, Trx_Amount double, Opp_Stage string, "
        "Opp_Type string, Opp_CloseMonth int, Opp_Prob double, Opps_Amount double, Acct_Name string, "
        "Acct_Owner string, Opp_Owner string, Acct_RegionHunter string")


def _trx(t, opp, off, amt, acct="A1"):
    return (t, opp, off, amt, "S", "New", 202001, 50.0, 100.0, acct, "Own", "OppOwn", "R")


def test_pipeline_tcv_groups(spark):
    pipe = "Opportunity Schedule"
    fact = spark.createDataFrame([
        _trx(pipe, "OP1", "F1", 10.0), _trx(pipe, "OP1", "F1", 5.0),        # summed
        _trx(pipe, "OP1", "F2", 3.0), _trx(pipe, "OP1", "F2", -3.0),        # zero: dropped
        _trx(pipe, None, "F1", 7.0), _trx(pipe, "OP2", None, 7.0),          # null keys: dropped
        _trx(pipe, "OP3", "F1", None),                                      # all-null sum: dropped
        _trx("Manual - SD", "OP4", "F1", 9.0),                              # other type
        _trx(pipe, "OP5", "F1", 4.0, "A1"), _trx("Manual - SD", "OP5", "F9", 1.0, "A2"),  # two accounts
    ], FACT)
    out = crm.pipeline_tcv(fact)
    assert rows(out, "Opp_Num", "Trx_Offering", "TCV_UnWPL", "Acct_Name") == [
        ("OP1", "F1", 15.0, "A1"), ("OP5", "F1", 4.0, "A1"), ("OP5", "F1", 4.0, "A2")]


def test_bill_party_ref_casts_and_fails_on_bad_id(spark):
    ok = spark.createDataFrame([("ACC1", "123"), ("ACC2", None)], "Acct_Id string, Acct_Party_ID__c string")
    assert rows(crm.bill_party_ref(ok)) == [("ACC1", 123)]
    bad = spark.createDataFrame([("ACC3", "x")], "Acct_Id string, Acct_Party_ID__c string")
    with pytest.raises((PySparkException, Py4JJavaError)):
        crm.bill_party_ref(bad).collect()


def test_offering_ref_latest_month(spark):
    import datetime as dt

    offr = spark.createDataFrame([("Old", "P1", dt.date(2020, 1, 1)), ("New", "P1", dt.date(2020, 3, 1)),
                                  ("X", None, dt.date(2021, 1, 1))],
                                 "Offr_Offering__c string, Offr_Product_Number__c string, "
                                 "Offr_Transaction_Month__c date")
    assert rows(crm.offering_ref(offr)) == [("P1", "New")]
