"""Broken records: kept out of the tables, and accounted for.

A reader hands its rows, with the text of each record that it could not parse, to
``split_rows``, which also tests what can't be cast to the table's types. What to do
with the rejected rows is the caller's choice (``on_reject``):

* ``"fail"``: the first one ends the job that reads it (the default: a broken export
  should not become a forecast);
* ``"quarantine"``: they go to a table of their own (``Quarantine``), and
  ``reconcile`` proves that every record read was either kept or rejected;
* ``"null"``: they stay, with null for what could not be read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType, StructType

CHOICES = ("fail", "quarantine", "null")


def cast_column(name: str, kind, lenient: bool) -> Column:
    """A text column as another type. Whole numbers may be written with a fraction of
    zero (a column with missing values)."""
    c = F.col(f"`{name}`")
    if isinstance(kind, StringType):
        return c
    if lenient:
        return c.try_cast("decimal(38,6)").try_cast(kind) if isinstance(kind, IntegralType) else c.try_cast(kind)
    return c.cast("decimal(38,6)").cast(kind) if isinstance(kind, IntegralType) else c.cast(kind)


def _read_too(*columns: Column) -> Column:
    """True, in a way that makes a plan read these columns."""
    return F.hash(*columns) >= F.lit(-(1 << 31))


def split_rows(df: DataFrame, corrupt: str, schema: StructType | None, on_reject: str) -> tuple[DataFrame, DataFrame | None]:
    """The good rows, typed by ``schema`` (by name; other columns stay as they are), and the
    rejected ones (``record``, ``reason``) if they are wanted.

    ``corrupt`` names the column with the text of unreadable records."""
    if on_reject not in CHOICES:
        raise ValueError(f"on_reject: {on_reject!r} is none of {CHOICES}")
    names = [c for c in df.columns if c != corrupt]
    types = {f.name: f.dataType for f in schema.fields if f.name in names and f.dataType != df.schema[f.name].dataType} \
        if schema else {}

    def typed(frame: DataFrame, lenient: bool) -> DataFrame:
        return frame.select(*[cast_column(c, types[c], lenient).alias(c) if c in types else F.col(f"`{c}`") for c in names])

    # Naming a data column too: a file source refuses plans that read nothing but the corrupt one.
    first = F.col(f"`{names[0]}`")
    unread = F.col(f"`{corrupt}`").isNotNull() & _read_too(first)
    if on_reject == "null":
        return typed(df, True), None
    wrong = [F.when(F.col(f"`{c}`").isNotNull() & cast_column(c, t, True).isNull(),
                    F.lit(f"{c}: not {t.simpleString()}")) for c, t in types.items()]
    if on_reject == "fail":
        text = F.concat(F.lit("broken record: "), F.substring(F.col(f"`{corrupt}`"), 1, 200))
        guarded = df.where(F.when(unread, F.raise_error(text).cast("boolean")).otherwise(F.lit(True)))
        return typed(guarded, False), None
    reason = F.concat_ws("; ", F.when(unread, F.lit("unreadable record")), *wrong)
    marked = df.withColumn("__reason", reason)
    record = F.coalesce(F.col(f"`{corrupt}`"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in names])))
    rejected = marked.where("__reason <> ''").select(record.alias("record"), F.col("__reason").alias("reason"))
    return typed(marked.where("__reason = ''"), True), rejected


class Quarantine:
    """A table of rejected records below ``path``, one partition for each source."""

    def __init__(self, spark: SparkSession, path: str, fail: bool = False):
        self.spark, self.path, self.fail = spark, path.rstrip("/"), fail
        self._kept: dict[str, tuple[DataFrame, DataFrame]] = {}

    def add(self, source: str, read: DataFrame, kept: DataFrame, rejected: DataFrame) -> DataFrame:
        """Write a source's rejected rows; returns those kept. ``read`` is what the
        reader gave before any row was set aside. With ``fail``, any rejected row is an error
        (once the table has them)."""
        folder = f"{self.path}/source={source}"
        rejected.write.mode("overwrite").parquet(folder)
        self._kept[source] = (read, kept)
        if self.fail:
            some = self.spark.read.parquet(folder).limit(3).collect()
            if some:
                raise ValueError(f"{source}: rejected records in {folder}, such as " + "; ".join(
                    f"{r.record[:80]!r} ({r.reason})" for r in some))
        return kept

    def rows(self) -> DataFrame:
        """All rejected records: ``source``, ``record``, ``reason``."""
        out = None
        for source in sorted(self._kept):
            one = self.spark.read.parquet(f"{self.path}/source={source}").select(F.lit(source).alias("source"), "record", "reason")
            out = one if out is None else out.unionByName(one)
        return out if out is not None else self.spark.createDataFrame([], "source string, record string, reason string")

    def report(self) -> DataFrame:
        """For each source ``n_read``, ``n_kept`` and ``n_rejected``, each counted on its own."""
        out = None
        for source in sorted(self._kept):
            read, kept = self._kept[source]
            counts = [(read, 1, 0, 0), (kept, 0, 1, 0), (self.spark.read.parquet(f"{self.path}/source={source}"), 0, 0, 1)]
            for df, *of in counts:
                # Every column is read: a file source parses only those of a plan.
                every = F.count_if(_read_too(*[F.col(f"`{c}`") for c in df.columns]))
                one = df.agg(every.alias("n")).select(F.lit(source).alias("source"), *[
                    (F.col("n") * k).alias(name) for k, name in zip(of, ("n_read", "n_kept", "n_rejected"), strict=True)])
                out = one if out is None else out.unionByName(one)
        if out is None:
            return self.spark.createDataFrame([], "source string, n_read long, n_kept long, n_rejected long")
        return out.groupBy("source").agg(*[F.sum(c).alias(c) for c in ("n_read", "n_kept", "n_rejected")])

    def reconcile(self) -> list[tuple[str, int, int, int]]:
        """The report's rows (one a source); an error unless read = kept + rejected."""
        found = [tuple(r) for r in self.report().orderBy("source").collect()]
        wrong = [r for r in found if r[1] != r[2] + r[3]]
        if wrong:
            raise ValueError(f"records lost or doubled: {wrong}")
        return found
