"""Places in a sorted order, without a task that sees all of a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ranked(df: DataFrame, group: str | None, order: list[str]) -> DataFrame:
    """The rows with ``position`` (from 0, within the group, in ``order``) and
    ``total`` (rows of the group, which must not be null).

    Rows are dealt by range of group and order and written sorted; a row's
    position is its distance from the first row of its group in its part, plus
    the group's rows in the parts before. Only the counts of (part, group)
    meet in a window. Equal rows may be dealt to several parts: their places
    among themselves say nothing."""
    by = [*([group] if group else []), *order]
    rows = df.withColumn("tie", F.monotonically_increasing_id()) \
        .repartitionByRange(*by, "tie").sortWithinPartitions(*by, "tie").drop("tie") \
        .withColumn("at", F.monotonically_increasing_id()) \
        .withColumn("part", F.shiftright("at", 33)).checkpoint()
    keys = ["part", *([group] if group else [])]
    all_parts = Window.partitionBy(*([group] if group else [F.lit(0)]))
    parts = rows.groupBy(*keys).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("k")).select(
        *keys, (F.sum("k").over(all_parts.orderBy("part")) - F.col("k") - F.col("first")).alias("shift"),
        F.sum("k").over(all_parts).alias("total"))
    return rows.join(parts, keys).withColumn("position", F.col("at") + F.col("shift")).drop("at", "part", "shift")
