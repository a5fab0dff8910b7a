"""Projection and rename operators driven by lists and dicts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project_strict(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep exactly ``cols``; a missing column is an error."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {missing}")
    return df.select(*[F.col(f"`{c}`") for c in cols])


def project_lenient(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep those of ``cols`` that exist, in list order."""
    present = set(df.columns)
    return df.select(*[F.col(f"`{c}`") for c in cols if c in present])


def rename_map(df: DataFrame, mapping: Mapping[str, str], keep_unmapped: bool = True) -> DataFrame:
    """Rename by ``mapping``; several sources may share one target.

    When more than one mapped source is present for a target, the target is
    the first non-null of them in mapping order. Unmapped columns are kept
    (in place) unless ``keep_unmapped`` is false.
    """
    present = set(df.columns)
    by_target: dict[str, list[str]] = {}
    for src, dst in mapping.items():
        if src in present:
            by_target.setdefault(dst, []).append(src)
    out: list[Column] = []
    done: set[str] = set()
    for c in df.columns:
        dst = mapping.get(c)
        if dst is None:
            if keep_unmapped and c not in by_target:
                out.append(F.col(f"`{c}`"))
            continue
        if dst in done:
            continue
        srcs = by_target[dst]
        expr = (F.col(f"`{srcs[0]}`") if len(srcs) == 1
                else F.coalesce(*[F.col(f"`{s}`") for s in srcs]))
        out.append(expr.alias(dst))
        done.add(dst)
    return df.select(*out)


def select_renamed(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Lenient projection to the keys of ``mapping`` (in key order), then
    rename to its values, merging shared targets by first non-null."""
    kept = project_lenient(df, list(mapping.keys()))
    return rename_map(kept, mapping, keep_unmapped=False)


def add_prefix(df: DataFrame, prefix: str) -> DataFrame:
    """Prefix every column name."""
    return df.toDF(*[prefix + c for c in df.columns])


def move_first(df: DataFrame, col: str) -> DataFrame:
    """Put ``col`` first, others in their order."""
    return df.select(F.col(f"`{col}`"), *[F.col(f"`{c}`") for c in df.columns if c != col])
