"""Rules with open fields: tuple-space search.

A rule table has one column for each field; a null leaves the field open (it fits
any value). Rules that give the same fields (one mask) form one hash table on those
fields, and rows look into each mask's table by a plain equi-join: at most ``2^k``
lookups for ``k`` fields, whatever the number of rules, and no rule is ever
compared with a row it does not fit. The rule of the most given fields wins.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import bounded_broadcast, left_enrich

# Rules of one mask that may be broadcast (their number is counted before).
BROADCAST_RULES = 100_000


def masks_of(rules: DataFrame, fields: list[str]) -> dict[int, int]:
    """How many rules each mask has (bit ``i``: the ``i``-th field is given). One
    aggregate of at most ``2^k`` rows."""
    mask = sum((F.when(F.col(f"`{f}`").isNotNull(), 1 << i).otherwise(0) for i, f in enumerate(fields)), F.lit(0))
    return {r.mask: r.n for r in rules.groupBy(mask.alias("mask")).agg(F.count(F.lit(1)).alias("n")).collect()}


def match_rules(df: DataFrame, rules: DataFrame, fields: Mapping[str, str], value: str | None = None,
                out: str = "rule", masks: Mapping[int, int | None] | None = None,
                broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """``df`` with ``<out>_mask``, the mask of the most special rule that fits a row (the one
    with the most fields given, of these the one with the last ones; null if none
    does), and with ``value`` also ``<out>_value``, the least value of its rules.

    ``fields`` maps rule columns to columns of ``df``. A row's null fits open fields
    only. Every row comes out once. ``masks`` (as ``masks_of``) saves counting them; where a
    number is None the optimizer's estimate decides on a broadcast."""
    names = list(fields)
    masks = masks_of(rules, names) if masks is None else masks
    found = df
    order = sorted((m for m, n in masks.items() if n != 0), key=lambda m: (bin(m).count("1"), m), reverse=True)
    for mask in order:
        given = [f for i, f in enumerate(names) if mask >> i & 1]
        of_mask = rules
        for i, f in enumerate(names):
            of_mask = of_mask.where(F.col(f"`{f}`").isNotNull() if mask >> i & 1 else F.col(f"`{f}`").isNull())
        worth = (F.min(F.col(f"`{value}`")) if value else F.lit(None)).alias(f"__v{mask}")
        table = of_mask.groupBy(*[F.col(f"`{f}`").alias(f"__{mask}_{f}") for f in given]).agg(
            worth, F.lit(True).alias(f"__m{mask}"))
        if not given:  # fits every row
            one = table.first()
            found = found.withColumns({f"__m{mask}": F.lit(True), f"__v{mask}": F.lit(one[f"__v{mask}"]).cast(
                rules.schema[value].dataType if value else "int")})
            continue
        keys = [f"__{mask}_{f}" for f in given]
        few = masks[mask] is not None and masks[mask] <= broadcast_rules
        if few or masks[mask] is None:
            found = found.join(F.broadcast(table) if few else bounded_broadcast(table), [F.col(f"`{fields[f]}`") == F.col(k) for f, k in zip(given, keys, strict=True)],
                               "left")
        else:  # rows with a null fit none of these rules, and are spread
            found = left_enrich(found, table, [fields[f] for f in given], keys, null_safe=False, null_salt=256,
                                salt_on=df.columns)
        found = found.drop(*keys)
    hit = F.lit(None).cast("int")
    worth = F.lit(None).cast(rules.schema[value].dataType) if value else None
    for mask in reversed(order):
        hit = F.when(F.col(f"__m{mask}"), F.lit(mask)).otherwise(hit)
        if value:
            worth = F.when(F.col(f"__m{mask}"), F.col(f"__v{mask}")).otherwise(worth)
    made = [F.col(f"`{c}`") for c in df.columns] + [hit.alias(f"{out}_mask")]
    return found.select(*made, *([worth.alias(f"{out}_value")] if value else []))
