"""Hot keys: a mergeable sketch that finds them and a join that splits them off.

``key_profile`` sketches any number of key columns in one aggregate (a frequent
items sketch for each, combined partially before the one-row shuffle) and names the
values, null among them, that hold more than a share of the rows. Which
values are named decides only how a join is carried out, never its result.

``split_join`` is a left join that treats such values apart. The right rows of the
hot values are few: they are broadcast, once their number has been checked, and
hot left rows meet them without a shuffle of their own. All other right rows are
joined by key; hot left rows take part in that shuffle under a salt that no right
row has, so they spread over all tasks and match nothing. The left side is read
once, and no right row is copied.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sizes import shuffled

# Values that a sketch keeps, and the share of the rows from which a value is hot.
TRACKED = 4096
SHARE = 1 / 512
# Right rows of hot values that may be broadcast.
HOT_ROWS = 100_000


def key_profile(df: DataFrame, keys: Mapping[str, Column], share: float = SHARE,
                tracked: int = TRACKED) -> dict[str, list]:
    """For each named key expression the values of at least about ``share`` of the
    rows (null as None), most frequent first. One aggregate of one row."""
    names = list(keys)
    most = max(1, min(tracked, int(2 / share)))
    one = df.select(*[keys[n].alias(f"k{i}") for i, n in enumerate(names)]).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.expr(f"approx_top_k(k{i}, {most}, {tracked})").alias(f"t{i}") for i in range(len(names))]).first()
    least = max(2, one["n"] * share)
    return {n: [t["item"] for t in one[f"t{i}"] or () if t["count"] >= least] for i, n in enumerate(names)}


def is_hot(keys: Sequence[Column], hot_values: Sequence = ()) -> Column:
    """Whether any of the keys is null or (single keys) a hot value; never null."""
    null = reduce(lambda x, y: x | y, [k.isNull() for k in keys])
    values = [v for v in hot_values if v is not None]
    if values and len(keys) == 1:
        return null | F.coalesce(keys[0].isin(values), F.lit(False))
    return null


def few_rows(df: DataFrame, most: int = HOT_ROWS) -> bool:
    """Whether a frame has at most so many rows (no more than these are counted)."""
    return df.limit(most + 1).count() <= most


def split_join(left: DataFrame, right: DataFrame, left_keys: Sequence[Column], right_keys: Sequence[str],
               hot_values: Sequence = (), salts: int = 256, salt_on: Sequence[Column] = (),
               null_safe: bool = True, few: bool | None = None) -> tuple[DataFrame, dict[str, Column]]:
    """``left`` joined with ``right`` (whose column names are not those of the left),
    and for each right column the expression of its value.

    If too many right rows have hot values to be broadcast, these rows alone are
    copied, one for each salt. They are counted, unless the caller knows that they are
    ``few``. Rows that several right rows of a hot value meet are multiplied after the
    shuffle, not before it."""
    keys = [F.col(k) for k in right_keys]
    hot, hot_right = is_hot(left_keys, hot_values), is_hot(keys, hot_values)
    spread = F.pmod(F.xxhash64(*salt_on), F.lit(salts))
    some, rest = right.where(hot_right), right.where(~hot_right)

    def same(other: Mapping[str, str]) -> Column:
        return reduce(lambda x, y: x & y, [
            l.eqNullSafe(F.col(other[r])) if null_safe else l == F.col(other[r])
            for l, r in zip(left_keys, right_keys, strict=True)])

    own = {c: c for c in right.columns}
    if not (few_rows(some) if few is None else few):
        rows = rest.withColumn("__rsalt", F.lit(0).cast("long")).unionByName(
            some.withColumn("__rsalt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))))
        salted = left.withColumn("__lsalt", F.when(hot, spread).otherwise(F.lit(0).cast("long")))
        joined = salted.join(shuffled(rows), same(own) & (F.col("__lsalt") == F.col("__rsalt")), "left")
        return joined.drop("__lsalt", "__rsalt"), {c: F.col(c) for c in right.columns}
    named = {c: f"__hot_{c}" for c in right.columns}
    joined = left.withColumn("__lsalt", F.when(hot, spread + 1).otherwise(F.lit(0).cast("long")))
    # Zero, but not as a literal: the optimizer would make the salt a filter, and the
    # shuffle would go by the key alone.
    rest = rest.withColumn("__rsalt", F.pmod(F.xxhash64(*keys), F.lit(1).cast("long")))
    plain = reduce(lambda x, y: x & y, [l == F.col(r) for l, r in zip(left_keys, right_keys, strict=True)])
    joined = joined.join(shuffled(rest), plain & (F.col("__lsalt") == F.col("__rsalt")), "left")
    joined = joined.join(F.broadcast(some.withColumnsRenamed(named)), same(named), "left")
    return joined, {c: F.coalesce(F.col(named[c]), F.col(c)) for c in right.columns}
