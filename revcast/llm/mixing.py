"""Mixing sources to target weights: weighted fair queueing.

Each source is a queue of its documents in shuffled order (by a hash of key
and size), gone through up to ``repeats`` times. A document's virtual finish time
is the number of its source's words up to and with it, divided by the source's
weight; the mix is all documents in order of finish time, cut where the
budget of words (by default the size of the table) is reached. A source that
runs out leaves its share to the others, so at the cut each source has about
``min(repeats * size, level * weight)`` words: its target.

All DataFrame operations. No window sees a whole source: running sums are made
in buckets of a source's hashes, whose sums are added up before; for the cut,
finish times are dealt by range and only the range of the cut is summed up row
by row. Equal rows of one key and size are counted before any shuffle.

Defined results: a null or empty text has size 0 and is never taken; a null
source is a source of its own, the last; rows of one key are
documents of their own, and a null key is a key; an empty table gives no rows. Only
key, source and text are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranks import ranked

WEIGHTS = (1, 2, 3)
REPEATS = 3
WORD = r"[^\x20\x09-\x0D]+"
# Rows of a bucket of hashes, about; copies that one generated row stands for.
BUCKET_ROWS = 50_000
COPIES = 10_000


def water_level(sources: DataFrame, budget: int) -> float:
    """The level at which ``min(cap, level * weight)`` of all sources adds up
    to ``budget``: the excess over the caps is shared again by weight until none
    is above. One aggregate row a round comes to the driver."""
    full = F.col("cap") <= F.col("weight") * F.col("level")
    level, before = 0.0, None
    while level != before:
        before = level
        capped, weight = sources.withColumn("level", F.lit(level)).agg(
            F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("weight")))).first()
        if not weight:
            return float("inf")
        level = (budget - (capped or 0)) / weight
    return level


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
        weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, budget: int | None = None) -> DataFrame:
    """One row per document: key, ``size``, ``source_size``, ``target`` (words of its
    source in the mix), ``finish`` (its first virtual finish time) and
    ``takes`` (how often the mix takes it)."""
    kind = docs.schema[key].dataType
    rows = docs.select(
        F.col(key).alias("key"),
        F.when(F.col(source).isNull(), "~").otherwise(F.concat(F.lit(":"), F.col(source).cast("string"))).alias("src"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size")).checkpoint()
    sources = rows.groupBy("src").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")).checkpoint()
    total, n = sources.agg(F.sum("source_size"), F.sum("n")).first()
    budget = min(repeats * (total or 0), (total or 0) if budget is None else budget)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    sources = ranked(sources, None, ["src"]).select(
        "src", "source_size", weight.cast("long").alias("weight"),
        (F.col("source_size") * repeats).alias("cap")).checkpoint()
    level = water_level(sources, budget)
    sources = sources.withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(level)))

    # Running sums: within buckets of a source's hashes, then over its buckets.
    buckets = max(1, -(-(n or 0) // BUCKET_ROWS))
    order = F.md5(F.concat_ws(":", F.coalesce(F.col("key").cast("string"), F.lit("-")), F.col("size").cast("string"))
                  .cast("binary"))
    same = rows.groupBy("src", "key", "size").agg(F.count(F.lit(1)).alias("copies")).withColumn("order", order)
    # The first seven hexadecimal digits, as a part of the whole range.
    share = F.conv(F.substring("order", 1, 7), 16, 10).cast("long")
    same = same.withColumn("bucket", F.floor(share * buckets / (1 << 28))).withColumn(
        "words", F.col("size") * F.col("copies"))
    sums = same.groupBy("src", "bucket").agg(F.sum("words").alias("s"))
    start = sums.select("src", "bucket", (F.sum("s").over(
        Window.partitionBy("src").orderBy("bucket")) - F.col("s")).alias("start")).join(sources.drop("cap"), "src")
    within = Window.partitionBy("src", "bucket").orderBy("order", "key", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    upto = same.withColumn("upto", F.sum("words").over(within)).join(start, ["src", "bucket"]).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))))
    queue = upto.withColumn("copy", F.explode(F.sequence(
        F.col("chunk") + 1, F.least(F.col("chunk") + COPIES, F.col("copies"))))).select(
        "key", "src", "size", "source_size", "weight", "target",
        (F.col("start") + F.col("upto") - (F.col("copies") - F.col("copy")) * F.col("size")).alias("words")).checkpoint()

    # A turn's key: finish time, then source and words served, which no two turns share.
    def turn(again: object) -> list:
        words = F.col("words") + again * F.col("source_size")
        return [(words / F.col("weight")).alias("finish"), F.col("src"), words.alias("served")]

    names = ["finish", "src", "served"]
    turns = queue.where("size > 0").withColumn("again", F.explode(F.array(*[F.lit(i).cast("long") for i in range(repeats)]))) \
        .select(*turn(F.col("again")), "size").repartitionByRange(*names).withColumn(
        "part", F.spark_partition_id()).checkpoint()
    parts = turns.groupBy("part").agg(F.sum("size").alias("s")).select(
        "part", F.sum("s").over(Window.orderBy("part")).alias("upto"), "s")
    over = parts.where(F.col("upto") > budget).orderBy("part").select("part", (F.col("upto") - F.col("s")).alias("start")).first()
    first_left = None
    if over is not None:
        running = Window.orderBy(*names).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        first_left = turns.where(F.col("part") == over["part"]).withColumn(
            "upto", F.lit(over["start"]) + F.sum("size").over(running)).where(F.col("upto") > budget).select(
            *names).orderBy(*names).first()
    takes = F.lit(0)
    for again in range(repeats):
        now = F.struct(*turn(F.lit(again).cast("long")))
        takes = takes + (F.lit(1) if first_left is None else (now < F.struct(
            F.lit(first_left["finish"]).alias("finish"), F.lit(first_left["src"]).alias("src"),
            F.lit(first_left["served"]).cast("long").alias("served"))).cast("int"))
    return queue.select(
        F.col("key").cast(kind).alias(key), "size", "source_size", "target", turn(F.lit(0).cast("long"))[0],
        F.when(F.col("size") > 0, takes).otherwise(0).cast("long").alias("takes"))


def mixture_report(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("takes")).alias("taken"))
