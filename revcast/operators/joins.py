"""Join operators: dataframe-style left enrichment and its helpers.

``left_enrich`` reproduces the column bookkeeping of a dataframe ``merge``
(suffixes on overlapping names, one column for a same-named key) on top of
a plain Spark join, so a chain of enrichment steps can be declared as data
(``JoinSpec`` / ``DeriveSpec``) and folded into one logical plan.

A right side is broadcast only when its rows take few bytes in memory (``operators.sizes``):
up to the optimizer's threshold, or up to the ceiling where the caller marks it as a
bounded dimension. Everything else is a shuffle join, which AQE may still turn into a
broadcast at runtime where no estimate was at hand. Rows with a null or hot key are
split off there (``operators.skew``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sizes import (DEFAULT_BROADCAST_CEILING, auto_broadcast_bytes, bounded_broadcast, estimated_bytes,  # noqa: F401
                    fits_broadcast, shuffled, sized_join)
from .skew import split_join

TASK_ROWS = 500_000


def parts_of(df: DataFrame, task_rows: int = TASK_ROWS) -> int:
    """How many partitions a frame's rows take at ``task_rows`` each, at least the session's
    number. Adaptive execution fills partitions up to a number of compressed bytes, which is
    many rows of a few narrow columns; partitions by number are left as they are."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // task_rows))


def _as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def left_enrich(left: DataFrame, right: DataFrame, left_on, right_on,
                suffixes: tuple[str, str] = ("_x", "_y"), *, null_safe: bool = True,
                how: str = "left", broadcast: bool = False,
                broadcast_ceiling: int = DEFAULT_BROADCAST_CEILING,
                null_salt: int = 0, hot_values: Sequence = (), salt_on: Sequence[str] = (),
                few_hot: bool | None = None) -> DataFrame:
    """Join ``right`` onto ``left`` with dataframe-merge naming.

    * Keys match null to null when ``null_safe`` (the default, as in the
      original pipeline); duplicate right keys fan out left rows.
    * A key with the same name on both sides is kept once (left values).
    * Other names present on both sides get ``suffixes`` (left, right).
    * Output: left columns in order, then right columns in order.

    ``null_salt > 1`` splits off left rows with a null key, or one of the
    ``hot_values`` (single-key joins), where the join has to shuffle: every null
    key hashes to one partition, and unmapped rows can be a large share of a
    fact. They meet the few right rows of these keys by a broadcast, and pass the
    shuffle spread over that many salts (``skew.split_join``). A salt is a hash of
    the ``salt_on`` columns, so a retried task salts the same way; without them of
    all columns, which then all have to be read. Where the right side is small
    enough to be broadcast there is no shuffle, and nothing is split. ``few_hot``: that the
    right rows of these keys are few, where this is known without counting them.
    """
    lk, rk = _as_list(left_on), _as_list(right_on)
    if len(lk) != len(rk):
        raise ValueError("left_on and right_on differ in length")
    lcols, rcols = left.columns, right.columns
    same = {l for l, r in zip(lk, rk) if l == r}
    overlap = (set(lcols) & set(rcols)) - same
    lsuf, rsuf = suffixes

    def lname(c):
        return c + lsuf if c in overlap else c

    def rname(c):
        return c + rsuf if c in overlap else c

    out_names = [lname(c) for c in lcols] + [rname(c) for c in rcols if c not in same]
    if len(set(out_names)) != len(out_names):
        raise ValueError(f"suffixes {suffixes} give duplicate columns: {out_names}")

    # Fresh names for the right side only: no ambiguity even when the same
    # frame is joined twice (role-playing dimensions). Left columns keep
    # their identity unless a suffix renames them, so a long chain adds few
    # aliases (fewer derived constraints for the optimizer to carry).
    rt = [f"__r{i}" for i in range(len(rcols))]
    l2 = left
    r2 = right.toDF(*rt)
    small = broadcast and fits_broadcast(right, broadcast_ceiling) or fits_broadcast(right, auto_broadcast_bytes(left))
    rpos = {c: i for i, c in enumerate(rcols)}

    def lref(c):
        return F.col(f"`{c}`")

    lkeys = [lref(a) for a in lk]
    rkeys = [F.col(rt[rpos[b]]) for b in rk]
    preds = [(l.eqNullSafe(r) if null_safe else l == r) for l, r in zip(lkeys, rkeys)]
    values = {c: F.col(c) for c in rt}
    if null_salt and null_salt > 1 and how == "left" and not small:
        joined, values = split_join(l2, r2, lkeys, [rt[rpos[b]] for b in rk], hot_values, null_salt,
                                    [lref(c) for c in salt_on or lcols], null_safe, few_hot)
    else:
        joined = sized_join(l2, r2, reduce(lambda x, y: x & y, preds), how, small=small)
    sel = [lref(c) if lname(c) == c else lref(c).alias(lname(c)) for c in lcols]
    sel += [values[rt[i]].alias(rname(c)) for i, c in enumerate(rcols) if c not in same]
    return joined.select(*sel)


@dataclass(frozen=True)
class JoinSpec:
    """One left-enrichment step: join catalog table ``right``."""

    right: str
    left_on: str | Sequence[str]
    right_on: str | Sequence[str]
    suffixes: tuple[str, str] = ("_x", "_y")
    null_safe: bool = True
    broadcast: bool = False
    null_salt: int = 0
    hot_values: tuple = ()
    salt_on: tuple = ()
    # Opt-in guard against fan-out (J7): fail the step if the right side
    # holds a key more than once.
    unique: bool = False

    @classmethod
    def from_dict(cls, d: Mapping) -> JoinSpec:
        return cls(right=d["right"], left_on=d["left_on"], right_on=d["right_on"],
                   suffixes=(d.get("suf1", "_x"), d.get("suf2", "_y")),
                   null_safe=d.get("null_safe", True), broadcast=d.get("broadcast", False),
                   null_salt=d.get("null_salt", 0), hot_values=tuple(d.get("hot_values", ())),
                   salt_on=tuple(d.get("salt_on", ())),
                   unique=d.get("unique", False))


@dataclass(frozen=True)
class DeriveSpec:
    """A derivation between joins: ``fn(df) -> df`` (usually withColumns)."""

    fn: Callable[[DataFrame], DataFrame]
    name: str = field(default="derive")
    # The columns that it reads, where known (``fanout`` then carries no others).
    reads: tuple | None = None


def enrich(df: DataFrame, catalog: Mapping[str, DataFrame],
           specs: Sequence[JoinSpec | DeriveSpec],
           broadcast_ceiling: int = DEFAULT_BROADCAST_CEILING) -> DataFrame:
    """Fold a chain of join and derive steps over ``df``."""
    for spec in specs:
        if isinstance(spec, DeriveSpec):
            df = spec.fn(df)
        else:
            if spec.unique:
                assert_unique_keys(catalog[spec.right], spec.right_on, spec.right)
            df = left_enrich(df, catalog[spec.right], spec.left_on, spec.right_on,
                             spec.suffixes, null_safe=spec.null_safe,
                             broadcast=spec.broadcast, broadcast_ceiling=broadcast_ceiling,
                             null_salt=spec.null_salt, hot_values=spec.hot_values, salt_on=spec.salt_on)
    return df


def assert_unique_keys(df: DataFrame, keys, name: str = "table", examples: int = 5) -> None:
    """Raise if any key of ``df`` occurs more than once (null counts as a
    key). One aggregate job, combined partially before its shuffle; only
    up to ``examples`` offending keys come back to the driver."""
    ks = _as_list(keys)
    dup = (df.groupBy(*[F.col(f"`{k}`") for k in ks]).agg(F.count(F.lit(1)).alias("n"))
           .where(F.col("n") > 1).limit(examples).collect())
    if dup:
        raise ValueError(f"{name}: duplicate keys {ks}: {[tuple(r) for r in dup]}")


def fanout_report(left: DataFrame, right: DataFrame, left_on: str, right_on: str,
                  null_safe: bool = True) -> DataFrame:
    """Keys at which a left join would multiply rows.

    Returns ``key, right_rows, left_rows`` for every key held by more than
    one right row and by at least one left row. Both sides are reduced by
    partial aggregation before the (small) join, so hot keys cost nothing
    extra.
    """
    dup = (right.groupBy(F.col(right_on).alias("key")).agg(F.count(F.lit(1)).alias("right_rows"))
           .where(F.col("right_rows") > 1))
    lcount = left.groupBy(F.col(left_on).alias("lkey")).agg(F.count(F.lit(1)).alias("left_rows"))
    cond = dup["key"].eqNullSafe(lcount["lkey"]) if null_safe else dup["key"] == lcount["lkey"]
    return shuffled(dup).join(shuffled(lcount), cond, "inner").select("key", "right_rows", "left_rows")


def anti_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str,
              null_safe: bool = True) -> DataFrame:
    """Left rows whose key does not occur on the right (null matches null
    when ``null_safe``). The right side is reduced to distinct keys first."""
    keys = right.select(F.col(right_on).alias("__k")).distinct()
    cond = (F.col(left_on).eqNullSafe(F.col("__k")) if null_safe
            else F.col(left_on) == F.col("__k"))
    return sized_join(left, keys, cond, "left_anti")
