"""Exclusion lists held in a table.

Literal lists belong into the plan (``functions.semantics``); a list of thousands or
millions of values is a table, and excluding it an anti-join. Both null regimes of
the literal forms are kept:

* ``keep_null=True`` (dataframe-style): listed values go; null rows stay, unless
  the list itself holds a null;
* ``keep_null=False`` (SQL ``NOT IN``): listed values go and so do nulls; a list
  that holds a null leaves no row, and an empty list leaves all.

A list whose number of values has been counted to be small is broadcast. Beyond
that, only rows whose value passes a Bloom filter of the list are shuffled and
anti-joined; all others can't be listed and go straight through. The filter's bits
are a broadcast table of one row of a bounded size, not a literal in the plan (which
the driver would copy and print many times); a list too long for it is anti-joined as
it is.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

BROADCAST_VALUES = 500_000
BITS_PER_VALUE, HASHES, MAX_BITS = 10, 4, 1 << 25


def bloom_filter(values: DataFrame, column: str, bits: int) -> DataFrame:
    """The filter of a column's values: one row, ``__one`` (zero) and ``__words``, an array of
    ``bits / 64`` numbers of 64 bits. It is put together in Spark and kept in the checkpoint folder; the driver
    never has it, but for the broadcast of its one row (``MAX_BITS / 8`` bytes at most)."""
    spark = values.sparkSession
    ensure_checkpoint_dir(spark)
    spots = F.explode(F.array(*[_spot(F.col(f"`{column}`"), k, bits) for k in range(HASHES)]))
    words = values.select(spots.alias("spot")).groupBy((F.col("spot") / 64).cast("long").alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(spot % 64 as int))")).alias("word"))
    # Words without a bit are zero.
    every = words.unionByName(spark.range(bits // 64).select(F.col("id").alias("at"), F.lit(0).cast("long").alias("word")))
    every = every.groupBy("at").agg(F.bit_or("word").alias("word"))
    in_order = F.sort_array(F.collect_list(F.struct("at", "word")))
    return every.agg(F.lit(0).cast("long").alias("__one"), F.transform(in_order, lambda x: x["word"]).alias("__words")).checkpoint()


def _spot(value: Column, k: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(value, F.lit(k)), F.lit(bits).cast("long"))


def bloom_words(values: DataFrame, column: str, bits: int) -> list[int]:
    """The numbers of a filter, in the driver (for small filters)."""
    return bloom_filter(values, column, bits).first()["__words"]


def may_hold(value: Column, words: Column | list[int], bits: int | None = None) -> Column:
    """Whether a value may be among those of a filter (false: it is not; null: null): a
    column of its words and its number of bits, or the words of a small filter."""
    if not isinstance(words, Column):
        bits, words = len(words) * 64, F.from_json(F.lit(json.dumps(words)), "array<bigint>")  # folded to one literal
    held = [F.call_function("getbit", F.get(words, (s / 64).cast("int")), (s % 64).cast("int")) == 1
            for s in (_spot(value, k, bits) for k in range(HASHES))]
    return F.when(value.isNotNull(), reduce(lambda x, y: x & y, held))


def exclude_table(df: DataFrame, column: str, listed: DataFrame, listed_column: str | None = None, keep_null: bool = True,
                  broadcast_values: int = BROADCAST_VALUES) -> DataFrame:
    """The rows of ``df`` whose ``column`` is not in ``listed`` (see above)."""
    name = listed_column or column
    values = listed.select(F.col(f"`{name}`").cast(df.schema[column].dataType).alias("__listed"))
    n, some_null = values.agg(F.count("__listed"), F.coalesce(F.bool_or(F.col("__listed").isNull()), F.lit(False))).first()
    value = F.col(f"`{column}`")
    if not keep_null and some_null:
        return df.where(F.lit(False))
    if not n:
        return df.where(value.isNotNull()) if some_null else df
    values = values.where(F.col("__listed").isNotNull()).distinct()
    rows = df if keep_null and not some_null else df.where(value.isNotNull())
    if n <= broadcast_values:
        return rows.join(F.broadcast(values), value == F.col("__listed"), "left_anti")
    bits = 64
    while bits < n * BITS_PER_VALUE:
        bits *= 2
    if bits > MAX_BITS:
        return rows.join(values, value == F.col("__listed"), "left_anti")
    words = F.broadcast(bloom_filter(values, "__listed", bits))
    # Every row has the key of the one filter, which is no literal: a join by a literal is a nested loop.
    one = F.pmod(F.xxhash64(value), F.lit(1).cast("long")) == F.col("__one")
    maybe = one & may_hold(value, F.col("__words"), bits)  # null values are not held
    passed = rows.join(words, maybe, "left_semi")
    return rows.join(words, maybe, "left_anti").unionByName(passed.join(values, value == F.col("__listed"), "left_anti"))
