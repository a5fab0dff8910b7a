"""Fiscal calendar as Column expressions (fiscal year starts in July)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import as_col


def fiscal_period(date) -> Column:
    """YYYYPP fiscal period of a date; July is period 1 of the next year.

    Shifting the date six months forward turns the fiscal calendar into the
    civil one, so the period is ``year*100 + month`` of the shifted date.
    Null stays null. Strings are parsed as ``yyyy-MM-dd``.
    """
    shifted = F.add_months(F.to_date(as_col(date)), 6)
    return (F.year(shifted) * 100 + F.month(shifted)).cast("int")


def fiscal_year_label(period) -> Column:
    """``'FY'`` plus the two year digits of a YYYYPP period.

    A null period gives null (the pandas original produced ``'FYn'``); the
    forecast exclusions keep null labels, so rows are kept either way.
    """
    p = as_col(period).cast("int").cast("string")
    return F.concat(F.lit("FY"), F.substring(p, 3, 2))
