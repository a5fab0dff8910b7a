"""Rules with open fields and exclusion lists in tables."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from revcast.operators import lists
from revcast.operators.rule_match import masks_of, match_rules

from conftest import rows


def plain_match(row, rules):
    """(mask, value) of the most special rule that fits."""
    best = None
    for *given, value in rules:
        if all(g is None or g == x for g, x in zip(given, row, strict=True)):
            mask = sum(1 << i for i, g in enumerate(given) if g is not None)
            rank = (bin(mask).count("1"), mask)
            if best is None or rank > best[0] or rank == best[0] and value < best[1]:
                best = (rank, value, mask)
    return (None, None) if best is None else (best[2], best[1])


@pytest.mark.parametrize("broadcast_rules", [100, 0])
@pytest.mark.parametrize("open_rule", [False, True])
def test_rules_of_all_masks(spark, broadcast_rules, open_rule):
    rng = random.Random(3)
    data = [tuple(rng.choice([None, 1, 2, 3]) for _ in range(3)) for _ in range(200)]
    rules = [tuple(rng.choice([1, 2, 3]) if m >> i & 1 else None for i in range(3)) + (rng.randrange(50),)
             for m in range(1, 8) for _ in range(3)]
    rules += [(None, None, None, 99)] * open_rule
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "id int, `a x` int, b int, c int")
    table = spark.createDataFrame(rules, "ra int, rb int, rc int, v int")
    got = match_rules(df, table, {"ra": "a x", "rb": "b", "rc": "c"}, value="v", broadcast_rules=broadcast_rules)
    assert got.columns == ["id", "a x", "b", "c", "rule_mask", "rule_value"]
    assert {r.id: (r.rule_mask, r.rule_value) for r in got.collect()} == {i: plain_match(r, rules) for i, r in enumerate(data)}
    assert masks_of(table, ["ra", "rb", "rc"]) == {**{m: 3 for m in range(1, 8)}, **({0: 1} if open_rule else {})}


def test_no_rules_and_one_mask_only(spark):
    df = spark.createDataFrame([(1, 5), (2, None)], "k int, b int")
    none = spark.createDataFrame([], "rk int, rb int")
    assert rows(match_rules(df, none, {"rk": "k", "rb": "b"})) == [(1, 5, None), (2, None, None)]
    one = spark.createDataFrame([(1, None), (1, None)], "rk int, rb int")
    plan = match_rules(df, one, {"rk": "k", "rb": "b"}, out="zero")
    assert rows(plan) == [(1, 5, 1), (2, None, None)]
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_contracted_value_by_rules_with_open_fields(spark):
    """All three kinds of rules at once, and a rule of party and order alone."""
    from conftest import SF001
    from revcast.plans.orders import contracted_tcv_fact
    from revcast.plans.pipeline import driver_run

    run = driver_run(spark, SF001)
    base = contracted_tcv_fact(run.order_base, run.cfg)
    some = base.select("BILL_TO_PARTY_ID", "ORDER_HEADER_ID").where("BILL_TO_PARTY_ID is not null").orderBy(
        "ORDER_HEADER_ID", "BILL_TO_PARTY_ID").limit(2).collect()
    open_rules = spark.createDataFrame([(some[0][0], None, some[0][1]), (some[1][0], None, None)],
                                       "party_id long, date_field date, order_header_id long")
    got = contracted_tcv_fact(run.order_base, run.cfg, run.party_date_rules, run.order_rules, open_rules)
    old = contracted_tcv_fact(run.order_base, run.cfg, run.party_date_rules, run.order_rules)
    assert got.columns == old.columns
    hit = ((F.col("BILL_TO_PARTY_ID") == some[0][0]) & (F.col("ORDER_HEADER_ID") == some[0][1])) | (
        F.col("BILL_TO_PARTY_ID") == some[1][0])
    want = old.withColumn("Amount", F.when(hit, F.lit(0).cast("decimal(18,2)")).otherwise(F.col("Amount")))
    assert rows(got, *old.columns) == rows(want, *old.columns) != rows(old, *old.columns)


# --- exclusion lists -----------------------------------------------------

@pytest.mark.parametrize("keep_null, null_left, null_listed, most", list(itertools.product(
    [True, False], [True, False], [True, False], [10, 0])))
def test_exclusion_by_a_table(spark, keep_null, null_left, null_listed, most):
    left = [1, 2, 2, 3, 4] + [None] * null_left
    listed = [2, 4, 4, 9] + [None] * null_listed
    df = spark.createDataFrame([(v, "x") for v in left], "k long, v string")
    table = spark.createDataFrame([(v,) for v in listed], "bad int")
    got = [r[0] for r in rows(lists.exclude_table(df, "k", table, "bad", keep_null=keep_null, broadcast_values=most))]
    if keep_null:  # pandas: ~isin
        want = [v for v in left if v not in listed]
    else:  # SQL NOT IN
        want = [] if null_listed else [v for v in left if v is not None and v not in listed]
    assert got == sorted(want, key=lambda v: (v is not None, v or 0))


@pytest.mark.parametrize("keep_null", [True, False])
@pytest.mark.parametrize("listed", [[], [None]])
def test_exclusion_by_an_empty_or_null_table(spark, keep_null, listed):
    df = spark.createDataFrame([(1,), (None,)], "k long")
    table = spark.createDataFrame([(v,) for v in listed], "k long")
    want = {(True, 0): [(None,), (1,)], (True, 1): [(1,)], (False, 0): [(None,), (1,)], (False, 1): []}
    assert rows(lists.exclude_table(df, "k", table, keep_null=keep_null)) == want[keep_null, len(listed)]


def test_many_ids_behind_a_bloom_filter(spark):
    """Only rows that pass the filter are shuffled; nothing of the result is lost."""
    ids = spark.range(200_000).select((F.col("id") * 7).alias("k"))
    df = spark.range(0, 700_000, 1, 4).select("id", F.when(F.col("id") % 100 != 0, F.col("id")).alias("k"))
    got = lists.exclude_table(df, "k", ids, broadcast_values=0)
    assert got.count() == sum(1 for i in range(700_000) if i % 100 == 0 or i % 7)
    words = lists.bloom_words(ids, "k", 1 << 21)
    passed = df.where(lists.may_hold(F.col("k"), words))
    listed = sum(1 for i in range(700_000) if i % 100 and i % 7 == 0)
    assert listed <= passed.count() < listed * 1.2
    assert passed.join(ids, "k", "left_semi").count() == listed
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "LeftAnti" in plan


def test_lists_too_long_for_a_filter(spark, monkeypatch):
    monkeypatch.setattr(lists, "MAX_BITS", 64)
    df, ids = spark.range(50).toDF("k"), spark.range(0, 50, 2).toDF("k")
    got = lists.exclude_table(df, "k", ids, broadcast_values=0)
    assert [r[0] for r in rows(got)] and sorted(r[0] for r in got.collect()) == list(range(1, 50, 2))
    assert "Union" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_filter_bits_stay_out_of_the_plan_and_the_driver(spark, monkeypatch):
    """The filter is a broadcast row: the plan's text does not grow with its bits, and the driver
    does not collect its words."""
    monkeypatch.setattr(lists, "bloom_words", None)
    ids = spark.range(20_000).select((F.col("id") * 7).alias("k"))
    df = spark.range(0, 70_000, 1, 4).select(F.when(F.col("id") % 100 != 0, F.col("id")).alias("k"))
    got = lists.exclude_table(df, "k", ids, broadcast_values=0)
    assert len(got._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    assert got.count() == sum(1 for i in range(70_000) if i % 100 == 0 or i % 7)
