"""Duplicate removal: distinct rows and latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Full-row DISTINCT (over ``cols`` when given)."""
    return (df.select(*cols) if cols else df).distinct()


def latest_per_key(df: DataFrame, key: str, order_col: str, value_cols: Sequence[str]) -> DataFrame:
    """One row per non-null ``key``: the one with the latest ``order_col``.

    Dates and timestamps are compared to the microsecond. Null order values lose to any date; ties go to the smallest value
    columns (nulls first), so the winner is deterministic. Written as an
    aggregate of ``min(struct(...))`` rather than a ranking window: the
    aggregate combines partially before the shuffle, so a key holding a
    third of the rows never lands whole in one task.
    """
    ordering = F.struct(
        F.col(order_col).isNull().alias("_o_null"),
        (-F.unix_micros(F.col(order_col).cast("timestamp"))).alias("_o_neg"),
        *[F.col(c).alias(f"_v{i}") for i, c in enumerate(value_cols)],
    )
    best = (df.where(F.col(key).isNotNull())
            .groupBy(key).agg(F.min(ordering).alias("_best")))
    return best.select(F.col(key), *[F.col(f"_best._v{i}").alias(c)
                                     for i, c in enumerate(value_cols)])
