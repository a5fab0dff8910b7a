"""Null semantics of the original pipeline, spelled out as Columns.

Two null regimes live side by side: the SQL extracts drop nulls in
``NOT IN`` / ``<>`` filters, the dataframe steps keep them and match a null
join key to a null join key. Each helper names which regime it follows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import as_col


def _split_values(values: Iterable) -> tuple[list, bool]:
    vals = list(values)
    return [v for v in vals if v is not None], any(v is None for v in vals)


def in_list_keep_null(c, values: Iterable) -> Column:
    """Membership where null is a value: a null probe is found iff the list
    holds a null. Never returns null."""
    vals, has_null = _split_values(values)
    col = as_col(c)
    hit = F.coalesce(col.isin(vals), F.lit(False)) if vals else F.lit(False)
    return (hit | col.isNull()) if has_null else hit


def exclude_keep_null(c, values: Iterable) -> Column:
    """Dataframe-style exclusion: rows whose value is listed go, null rows
    stay (unless the list itself holds a null)."""
    return ~in_list_keep_null(c, values)


def exclude_drop_null(c, values: Iterable) -> Column:
    """SQL ``NOT IN``: listed values go and so do nulls."""
    vals = list(values)
    col = as_col(c)
    if not vals:
        return col.isNotNull()
    return ~col.isin(vals)


def concat_nulls_as_empty(*parts) -> Column:
    """String concatenation where null counts as an empty string (the
    ``||`` of the order system). ``concat_ws`` is not used, as it drops the
    separator next to a null."""
    return F.concat(*[F.coalesce(as_col(p).cast("string"), F.lit("")) for p in parts])


def product_key(number, fmt, language) -> Column:
    """``number-format-language`` product key; missing parts become ''."""
    return concat_nulls_as_empty(number, F.lit("-"), fmt, F.lit("-"), language)


def trim_to_null(c) -> Column:
    """Strip leading and trailing whitespace; a blank result is null (the
    order system stores '' as null)."""
    trimmed = F.regexp_replace(as_col(c), r"^\s+|\s+$", "")
    return F.when(trimmed == "", F.lit(None).cast("string")).otherwise(trimmed)


def first_non_null(*cols) -> Column:
    """``NVL`` / ``coalesce``."""
    return F.coalesce(*[as_col(c) for c in cols])
