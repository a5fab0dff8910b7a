"""Property tests: the Column rules against plain-Python models of the
batches of rows."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from revcast.functions import rules as R
from revcast.functions.fiscal import fiscal_period, fiscal_year_label
from revcast.functions.semantics import product_key, trim_to_null

SETTINGS = settings(max_examples=8, deadline=None)
dates = st.one_of(st.none(), st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2060, 12, 31)))
periods = st.one_of(st.none(), st.integers(min_value=199001, max_value=206012))
probs = st.one_of(st.none(), st.sampled_from([0.0, 10.0, 50.0, 99.5, 100.0]))
codes = st.sampled_from(["RecRev", "DefRev", "BillEv", "PipeLn", "Schl", "POH", "unmapped", "NA"])
texts = st.one_of(st.none(), st.text(alphabet="ab -\t", max_size=6))


def fp_model(d):
    if d is None:
        return None
    return (d.year + 1) * 100 + d.month - 6 if d.month >= 7 else d.year * 100 + d.month + 6


def flag_model(p, c, pr):
    legacy = p is not None and p <= 201712 and c == "RecRev"
    pipe = c == "PipeLn" and pr is not None and pr > 0
    new = p is not None and p >= 201801 and c in ("RecRev", "BillEv", "DefRev", "Schl")
    return "Yes" if legacy or pipe or new else "No"


@SETTINGS
@given(st.lists(dates, min_size=1, max_size=40))
def test_fiscal_period_model(spark, ds):
    df = spark.createDataFrame([(d,) for d in ds], "d date")
    got = [tuple(r) for r in df.select(fiscal_period("d").alias("p"))
           .select("p", fiscal_year_label("p")).collect()]
    want = [(fp_model(d), None if d is None else "FY" + str(fp_model(d))[2:4]) for d in ds]
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(periods, codes, probs), min_size=1, max_size=40))
def test_inclusion_flag_model(spark, rows_):
    df = spark.createDataFrame(rows_, "p int, c string, pr double")
    got = [r[0] for r in df.select(R.inclusion_flag("p", "c", "pr")).collect()]
    assert got == [flag_model(*r) for r in rows_]


@SETTINGS
@given(st.lists(st.tuples(codes, probs, st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False))),
                min_size=1, max_size=40))
def test_weighted_model(spark, rows_):
    df = spark.createDataFrame(rows_, "c string, p double, a double")
    got = [r[0] for r in df.select(R.weighted("a", "p", R.is_pipeline("c"))).collect()]
    want = [(None if (p is None or a is None) else (p / 100) * a) if c == "PipeLn" else a
            for c, p, a in rows_]
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(texts, texts, texts), min_size=1, max_size=40))
def test_fallback_and_product_key_model(spark, rows_):
    df = spark.createDataFrame(rows_, "a string, b string, c string")
    got = [tuple(r) for r in df.select(R.account_fallback("a", "b", "c"), R.account_source("a", "b", "c"),
                                       product_key("a", "b", "c")).collect()]
    want = []
    for a, b, c in rows_:
        first = next(((v, s) for v, s in ((a, "opp"), (b, "bill2"), (c, "prnt")) if v is not None),
                     ("unmapped", "unmapped"))
        want.append((first[0], first[1], f"{a or ''}-{b or ''}-{c or ''}"))
    assert got == want


@SETTINGS
@given(st.lists(texts, min_size=1, max_size=40))
def test_trim_to_null_model(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(trim_to_null("s")).collect()]
    want = [None if v is None or v.strip(" \t") == "" else v.strip(" \t") for v in vals]
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(
    ["1", "2", "3", "Opportunity Schedule", "Manual - SD", "PO Hold", "7", "x"])),
    st.sampled_from(["Scheduled", "Unscheduled", "Soft Scheduled", "Project Initiated", "Closed",
                     "Canceled", "Other"]) | st.none()), min_size=1, max_size=40))
def test_revenue_code_model(spark, rows_):
    stage_map = {"Scheduled": "Schl", "Unscheduled": "UnSchl", "Soft Scheduled": "SoftSchl",
                 "Project Initiated": "ProjInit", "Closed": "Closed", "Canceled": "Canceled"}
    code_map = {"1": "RecRev", "2": "DefRev", "3": "BillEv", "Opportunity Schedule": "PipeLn", "PO Hold": "POH"}
    df = spark.createDataFrame(rows_, "t string, s string")
    stage = R.project_stage_code("s")
    got = [r[0] for r in df.select(R.revenue_code("t", stage)).collect()]
    want = [stage_map.get(s, "NA") if t == "Manual - SD" else code_map.get(t, "unmapped") for t, s in rows_]
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["P1", "P2", "P3"])),
                          st.one_of(st.none(), st.sampled_from(["a", "b", "c"])),
                          st.one_of(st.none(), st.sampled_from([dt.date(2020, m, 1) for m in (1, 2, 3)]))),
                min_size=1, max_size=30))
def test_latest_per_key_model(spark, rows_):
    from revcast.operators.dedup import latest_per_key

    df = spark.createDataFrame(rows_, "p string, o string, m date")
    got = sorted((tuple(r) for r in latest_per_key(df, "p", "m", ["o"]).collect()), key=repr)
    want = {}
    for p, o, m in rows_:
        if p is None:
            continue
        key = (m is None, -(m.toordinal() if m else 0), o is not None, o or "")
        if p not in want or key < want[p][0]:
            want[p] = (key, o)
    assert got == sorted(((p, v[1]) for p, v in want.items()), key=repr)
