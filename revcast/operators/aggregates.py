"""Aggregation operators: keyed sums, non-zero filter, column census.

All of them are ordinary ``groupBy().agg()`` plans, so Spark combines
partially on the map side before the shuffle: a key holding a third of the
rows costs one partial row per task, not a hot reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(18,2)"


def money(c) -> F.Column:
    """Money as DECIMAL(18,2): sums do not depend on addition order."""
    return (c if isinstance(c, F.Column) else F.col(c)).cast(MONEY)


def sum_by(df: DataFrame, keys: Sequence[str], value: str, alias: str | None = None,
           drop_null_keys: bool = False, nonzero: bool = False) -> DataFrame:
    """Sum ``value`` per ``keys``.

    ``drop_null_keys`` follows dataframe grouping (rows with a null key are
    left out); SQL grouping keeps them as a group. ``nonzero`` drops groups
    whose sum is zero or null.
    """
    if drop_null_keys:
        df = df.dropna(subset=list(keys))
    out = df.groupBy(*keys).agg(F.sum(value).alias(alias or value))
    if nonzero:
        out = out.where(F.col(alias or value) != 0)
    return out


# Value classes of the census, tested on the text form of each value.
_CLASSES = (
    ("int", r"^-?[0-9]+$"),
    ("float", r"^-?[0-9]*\.[0-9]+([eE][-+]?[0-9]+)?$"),
    ("date", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T].*)?$"),
)


def _kind(value: Column, kind: T.DataType) -> Column:
    """The kind of a value, null for null: from the column's type where that
    settles it, else from the value's text."""
    if isinstance(kind, T.IntegralType):
        return F.when(value.isNotNull(), "int")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.when(value.isNotNull(), "date")
    text = value.cast("string")
    out = F.when(text.isNull(), F.lit(None).cast("string"))
    for name, pattern in _CLASSES:
        out = out.when(text.rlike(pattern), name)
    return out.otherwise("str")


def column_census(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """How many values of each kind every column holds.

    Returns long form ``column_name, value_type, n`` with one row per
    (column, kind) that occurs; kinds are null, int, float, date and str,
    decided on the text form of the value. One global aggregate (partial
    per task) followed by an unpivot.
    """
    cols = list(columns or df.columns)
    names = [k for k, _ in _CLASSES] + ["str"]
    aggs = []
    for i, c in enumerate(cols):
        kind = _kind(F.col(f"`{c}`"), df.schema[c].dataType)
        aggs.append(F.count_if(kind.isNull()).alias(f"c{i}_null"))
        aggs += [F.count_if(kind == k).alias(f"c{i}_{k}") for k in names]
    wide = df.agg(*aggs)
    kinds = ["null", *names]
    stack_args = ", ".join(
        f"'{c.replace(chr(39), chr(39) * 2)}', '{k}', c{i}_{k}"
        for i, c in enumerate(cols) for k in kinds)
    n = len(cols) * len(kinds)
    long = wide.selectExpr(f"stack({n}, {stack_args}) as (column_name, value_type, n)")
    return long.where(F.col("n") > 0)
