"""The dataframe-style operators against pandas itself, whose semantics the
original pipeline had: merge suffixes and null-to-null matching (N1, N12),
``~isin`` keeping nulls (N2, N3), grouping that drops null keys (N4)."""

import math

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from revcast.functions.semantics import exclude_keep_null
from revcast.operators.aggregates import sum_by
from revcast.operators.joins import anti_join, left_enrich

SETTINGS = settings(max_examples=10, deadline=None)
keys = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
vals = st.one_of(st.none(), st.sampled_from(["x", "y"]))


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return v


def _rows(records):
    return sorted((tuple(_norm(v) for v in r) for r in records), key=repr)


@SETTINGS
@given(st.lists(st.tuples(keys, vals), min_size=1, max_size=12),
       st.lists(st.tuples(keys, vals, vals), min_size=1, max_size=6),
       st.sampled_from([("_x", "_y"), ("", "_Opps"), ("_Bill2map", "_Final")]))
def test_left_enrich_matches_pandas_merge(spark, left, right, suffixes):
    lpd = pd.DataFrame(left, columns=["k", "name"], dtype=object)
    rpd = pd.DataFrame(right, columns=["rk", "name", "extra"], dtype=object)
    want = lpd.merge(rpd, left_on="k", right_on="rk", how="left", suffixes=suffixes)
    ldf = spark.createDataFrame(left, "k string, name string")
    rdf = spark.createDataFrame(right, "rk string, name string, extra string")
    got = left_enrich(ldf, rdf, "k", "rk", suffixes)
    assert got.columns == list(want.columns)
    assert _rows(got.collect()) == _rows(want.itertuples(index=False))


@SETTINGS
@given(st.lists(st.tuples(keys, vals), min_size=1, max_size=12),
       st.lists(st.tuples(keys, vals), min_size=1, max_size=6))
def test_same_named_key_matches_pandas_merge(spark, left, right):
    lpd = pd.DataFrame(left, columns=["k", "v"], dtype=object)
    rpd = pd.DataFrame(right, columns=["k", "w"], dtype=object)
    want = lpd.merge(rpd, on="k", how="left")
    got = left_enrich(spark.createDataFrame(left, "k string, v string"),
                      spark.createDataFrame(right, "k string, w string"), "k", "k")
    assert got.columns == list(want.columns)
    assert _rows(got.collect()) == _rows(want.itertuples(index=False))


@SETTINGS
@given(st.lists(keys, min_size=1, max_size=12), st.lists(keys, min_size=0, max_size=6))
def test_anti_join_and_exclusion_match_isin(spark, opps, reported):
    opd = pd.DataFrame({"n": pd.Series(opps, dtype=object)})
    rep = pd.Series(reported, dtype=object).drop_duplicates()
    want = opd[~opd["n"].isin(rep)]
    odf = spark.createDataFrame([(o,) for o in opps], "n string")
    rdf = spark.createDataFrame([(r,) for r in reported], "r string")
    assert _rows(anti_join(odf, rdf, "n", "r").collect()) == _rows(want.itertuples(index=False))
    listed = [r for r in reported]
    want2 = opd[~opd["n"].isin(listed)]
    assert _rows(odf.where(exclude_keep_null("n", listed)).collect()) == _rows(want2.itertuples(index=False))


@SETTINGS
@given(st.lists(st.tuples(keys, keys, st.one_of(st.none(), st.sampled_from([-2.0, 0.0, 1.0, 2.5]))),
                min_size=1, max_size=20))
def test_sum_by_matches_pandas_pivot(spark, rows_):
    pdf = pd.DataFrame(rows_, columns=["o", "f", "a"]).astype({"o": object, "f": object, "a": float})
    want = pdf.pivot_table(index=["o", "f"], values="a", aggfunc="sum")
    want = want[want["a"] != 0].reset_index() if len(want) else pd.DataFrame(columns=["o", "f", "a"])
    df = spark.createDataFrame(rows_, "o string, f string, a double")
    got = sum_by(df, ["o", "f"], "a", drop_null_keys=True, nonzero=True)
    assert _rows(got.collect()) == _rows(want[["o", "f", "a"]].itertuples(index=False))
