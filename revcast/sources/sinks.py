"""Sinks: layered parquet outputs and dated snapshots.

Layers mirror the stages of the original (full pulls, curated sources,
enriched facts, forecasts). Writes are parquet; snapshots are partitions of
one table keyed by ``snapshot_date`` and written with dynamic partition
overwrite, so re-running a day replaces only that day and readers prune to
the day they ask for.
"""

from __future__ import annotations

import datetime as _dt
import os
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LAYERS = ("raw", "source", "fact", "forecast")


def write_layer(frames: Mapping[str, DataFrame], root: str, layer: str, mode: str = "overwrite",
                order: Mapping[str, Sequence[str]] | None = None) -> dict[str, str]:
    """One parquet table per named frame under ``root/layer``, those named in
    ``order`` in a total order (O1)."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    paths = {}
    for name, df in frames.items():
        p = os.path.join(root, layer, name)
        if order and name in order:
            write_ordered(df, p, order[name], mode)
        else:
            df.write.mode(mode).parquet(p)
        paths[name] = p
    return paths


def _direction(col: str) -> tuple[str, bool]:
    """Name and whether ascending; a leading ``-`` turns the order round."""
    return (col[1:], False) if col.startswith("-") else (col, True)


def write_ordered(df: DataFrame, path: str, cols: Sequence[str], mode: str = "overwrite") -> str:
    """O1: write ``df`` in a total order of ``cols`` (``-`` before a name: from the greatest
    down; nulls come first either way): rows are dealt by range (a shuffle) and sorted within each
    part file, whose names go up with the order. For extracts whose readers rely on the
    order. ``order_proof`` tells whether files are so."""
    df.orderBy(*[F.col(f"`{c}`").asc_nulls_first() if up else F.col(f"`{c}`").desc_nulls_first()
                 for c, up in map(_direction, cols)]).write.mode(mode).parquet(path)
    return path


def _not_after(before: str, now: str, cols: Sequence[str]) -> Column:
    """Whether the row in struct ``before`` may stand before that in ``now``."""
    out = F.lit(True)
    for i, up in reversed([(i, up) for i, (_, up) in enumerate(map(_direction, cols))]):
        x, y = F.col(f"{before}.c{i}"), F.col(f"{now}.c{i}")
        less = F.coalesce(x < y if up else x > y, x.isNull() & y.isNotNull())
        out = less | (x.eqNullSafe(y) & out)
    return out


def order_proof(spark: SparkSession, path: str, cols: Sequence[str]) -> DataFrame:
    """O1: the zone map of a written table: for each part file its number, rows, first and
    last keys, ``in_file`` (no row stands before its predecessor) and ``after``
    (its first row does not stand before the last one of the file with rows before it,
    whatever the gap between their numbers)."""
    keys = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, (c, _) in enumerate(map(_direction, cols))])
    rows = spark.read.parquet(path).select(
        F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int").alias("part"),
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"), keys.alias("now"))
    rows = rows.withColumn("before", F.lag("now").over(Window.partitionBy("part", "file").orderBy("at")))
    ok = F.col("before").isNull() | _not_after("before", "now", cols)
    zones = rows.groupBy("part", "file").agg(
        F.count(F.lit(1)).alias("rows"), F.min_by("now", "at").alias("first"), F.max_by("now", "at").alias("last"),
        F.bool_and(ok).alias("in_file"))
    # One row a file from here on.
    zones = zones.withColumn("previous", F.lag("last").over(Window.orderBy("part", "file")))
    return zones.withColumn("after", F.col("previous").isNull() | _not_after("previous", "first", cols)).drop("previous")


def assert_ordered(spark: SparkSession, path: str, cols: Sequence[str]) -> None:
    """Raise unless a written table is in the total order of ``cols``."""
    bad = order_proof(spark, path, cols).where("not in_file or not after").select("file").limit(5).collect()
    if bad:
        raise ValueError(f"{path}: not in the order of {list(cols)}, see {[r.file for r in bad]}")


def write_snapshot(df: DataFrame, path: str, snapshot_date: _dt.date | str,
                   sort_cols: tuple[str, ...] = ()) -> str:
    """Write ``df`` as the ``snapshot_date`` partition of ``path``.

    Only that partition is replaced (dynamic partition overwrite). Sorting
    within partitions is optional and local to each task (O1 at the sink),
    never a global sort.
    """
    day = snapshot_date if isinstance(snapshot_date, str) else snapshot_date.isoformat()
    out = df.withColumn("snapshot_date", F.lit(day).cast("date"))
    if sort_cols:
        out = out.sortWithinPartitions(*sort_cols)
    (out.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("snapshot_date").parquet(path))
    return path


def read_snapshot(spark: SparkSession, path: str, snapshot_date: _dt.date | str | None = None) -> DataFrame:
    """Read one snapshot (partition-pruned) or all of them."""
    df = spark.read.parquet(path)
    if snapshot_date is not None:
        day = snapshot_date if isinstance(snapshot_date, str) else snapshot_date.isoformat()
        df = df.where(F.col("snapshot_date") == F.lit(day).cast("date"))
    return df
