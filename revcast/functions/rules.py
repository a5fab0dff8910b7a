"""Forecast business rules as Column expressions.

Every rule of the original was a Python function applied row by row; here
each one is a ``Column`` so it stays inside whole-stage codegen. Rules take
columns or column names and return a Column.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from ._cols import as_col


def _lookup(c: Column, mapping: Mapping[str, str], default) -> Column:
    """``when`` chain over a small fixed mapping, then ``default``."""
    expr = None
    for k, v in mapping.items():
        expr = (F.when(c == k, F.lit(v)) if expr is None
                else expr.when(c == k, F.lit(v)))
    return expr.otherwise(default) if expr is not None else default


def project_stage_code(stage) -> Column:
    """Project stage -> short code; unknown or null -> 'NA'."""
    return _lookup(as_col(stage), K.PROJECT_STAGE_CODES, F.lit(K.PROJECT_STAGE_DEFAULT))


def revenue_code(revenue_type, stage_code) -> Column:
    """Revenue type id -> revenue code.

    Ids are compared as text, so 1 and '1' agree (the original missed
    '2' and '3'). 'Manual - SD' takes the mapped project stage.
    """
    t = as_col(revenue_type).cast("string")
    expr = _lookup(t, K.REVENUE_TYPE_CODES, None)
    return (F.when(t == K.REVENUE_TYPE_FROM_STAGE, as_col(stage_code))
            .otherwise(F.coalesce(expr, F.lit(K.REVENUE_TYPE_DEFAULT))))


def weighted(amount, probability, condition) -> Column:
    """``probability/100 * amount`` where ``condition`` holds, else amount."""
    p = as_col(probability).cast("double")
    a = as_col(amount).cast("double")
    return F.when(condition, (p / 100) * a).otherwise(a)


def is_pipeline(revenue_code_col) -> Column:
    return as_col(revenue_code_col) == K.PIPELINE_CODE


def account_fallback(opp_account, bill_account, parent_account) -> Column:
    """First non-null of the three account ids, else 'unmapped'."""
    return F.coalesce(as_col(opp_account), as_col(bill_account),
                      as_col(parent_account), F.lit("unmapped"))


def account_source(opp_account, bill_account, parent_account) -> Column:
    """Which of the three account ids ``account_fallback`` took."""
    return (F.when(as_col(opp_account).isNotNull(), F.lit("opp"))
            .when(as_col(bill_account).isNotNull(), F.lit("bill2"))
            .when(as_col(parent_account).isNotNull(), F.lit("prnt"))
            .otherwise(F.lit("unmapped")))


def inclusion_flag(period, code, probability,
                   last_legacy_period: int = K.LAST_LEGACY_PERIOD,
                   first_new_period: int = K.FIRST_NEW_PERIOD,
                   new_period_codes=K.NEW_PERIOD_CODES) -> Column:
    """'Yes' when a row counts in the forecast, else 'No'.

    A null comparison is not true, so rows with a null period or
    probability fall to 'No' unless another branch holds.
    """
    p, c, pr = as_col(period), as_col(code), as_col(probability)
    legacy = (p <= last_legacy_period) & (c == "RecRev")
    pipeline = (c == K.PIPELINE_CODE) & (pr > 0)
    current = (p >= first_new_period) & c.isin(list(new_period_codes))
    return F.when(legacy | pipeline | current, F.lit("Yes")).otherwise(F.lit("No"))


def tcv_period(src, transaction_period, close_period) -> Column:
    """Actuals use the transaction period, pipeline and unreported rows the
    close period."""
    s = as_col(src)
    return (F.when(s == K.SRC_ACTUAL, as_col(transaction_period))
            .when(s.isin(K.SRC_PIPELINE, K.SRC_UNREPORTED), as_col(close_period)))


def unweighted_tcv(src, actual_amount, pipeline_amount) -> Column:
    s = as_col(src)
    return (F.when(s == K.SRC_ACTUAL, as_col(actual_amount).cast("double"))
            .when(s == K.SRC_PIPELINE, as_col(pipeline_amount).cast("double"))
            .when(s == K.SRC_UNREPORTED, F.lit(0.0)))


def weighted_tcv(src, unweighted, probability) -> Column:
    s = as_col(src)
    u = as_col(unweighted).cast("double")
    return (F.when(s == K.SRC_PIPELINE, (as_col(probability).cast("double") / 100) * u)
            .when(s == K.SRC_UNREPORTED, F.lit(0.0))
            .when(s == K.SRC_ACTUAL, u))


def pipeline_weighted_tcv(src, unweighted, probability) -> Column:
    s = as_col(src)
    u = as_col(unweighted).cast("double")
    return (F.when(s == K.SRC_PIPELINE, (as_col(probability).cast("double") / 100) * u)
            .otherwise(F.lit(0.0)))


def owner(pipeline_condition, opp_owner, account_owner) -> Column:
    """Opportunity owner for pipeline rows, account owner otherwise."""
    return F.when(pipeline_condition, as_col(opp_owner)).otherwise(as_col(account_owner))


def revenue_type_by_date(date, as_of) -> Column:
    """1 (recognised) when the date is on or before the day before
    ``as_of``, else 2 (deferred); a null date is deferred."""
    cutoff = F.date_sub(F.to_date(as_col(as_of)), 1)
    return (F.when(F.to_date(as_col(date)) <= cutoff, F.lit(K.RECOGNISED_TYPE))
            .otherwise(F.lit(K.DEFERRED_TYPE)))


def hold_category(flag) -> Column:
    """'PO Hold' when the hold flag is 'Y', else null."""
    return F.when(as_col(flag) == K.HOLD_FLAG, F.lit(K.HOLD_CATEGORY))


def apply_overrides(c, overrides: Mapping[str, str]) -> Column:
    """Replace listed single values (e.g. a mistyped id); others pass."""
    col = as_col(c)
    return _lookup(col, overrides, col)


def override_if_present(line_value, direct_value) -> Column:
    """Milestone override: the line-item value when it is present."""
    return F.coalesce(as_col(line_value), as_col(direct_value))


def override_if_key_present(line_key, line_value, direct_value) -> Column:
    """Milestone override gated on the line-item opportunity number: when
    that number exists the line-item value wins even if it is null."""
    return F.when(as_col(line_key).isNotNull(), as_col(line_value)).otherwise(as_col(direct_value))


def milestone_type_name(record_type) -> Column:
    """Record-type id -> milestone type name; unknown ids pass through."""
    c = as_col(record_type)
    return _lookup(c, K.MILESTONE_RECORD_TYPES, c)
