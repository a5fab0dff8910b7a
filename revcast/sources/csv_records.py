"""CSV files read by many tasks, line breaks in fields included.

A file whose quoted fields hold no line break is split by Spark's own reader. Where
they do, a byte range may begin inside quotes, so ranges can't be read on their own:

1. one pass counts the quotes of each range (``RANGE_LINES`` lines at most of a file split
   as the text source makes it). An odd number turns "inside quotes" on or off, so the running
   parity of the ranges before tells each range how it begins; files in which no
   line has an odd number of quotes go to Spark's reader;
2. the lines of a range are put together to records, as those begin where the
   parity is even. What a range holds before its first record, and its last record, may
   go on over the edge: only these pieces (two a range at most) meet across ranges;
3. records are parsed by ``from_csv`` with the options of the reader.

Lines are shuffled once, by range, with a digest in place of the file's path; a range is
of the same size in small and large files, and a task holds the lines of a few ranges.
Files have to be as dataframe libraries write them: a field with a quote,
a separator or a line break is quoted, and a quote in it is doubled.
The encoding has to keep ASCII bytes (UTF-8, ISO-8859-x).
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.joins import parts_of

# A record that is not as long as the header has its text here.
CORRUPT = "__corrupt"
OPTIONS = {"quote": '"', "escape": '"'}
# Lines of a range: 2 to this power.
RANGE_BITS = 15


def _lines(spark: SparkSession, paths: str | list[str], encoding: str) -> DataFrame:
    """Lines (without the line feed) with their file, range and order in it."""
    text = F.decode(F.col("value").cast("binary"), encoding)
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), text.alias("line"))


_ODD = "(length(line) - length(replace(line, '\"', ''))) % 2"


def joined_records(spark: SparkSession, paths: list[str], encoding: str) -> DataFrame:
    """The records (``text``) of the files but for their headers."""
    # Ranges in their order in the file: the start of the split, then the count of its task's rows.
    row = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    lines = _lines(spark, paths, encoding).withColumns({
        "quotes": F.expr(_ODD), "file": F.unhex(F.md5("file")),
        "block": F.shiftleft("block", 20) + F.shiftright(row, RANGE_BITS)})
    ranges = lines.groupBy("file", "block").agg((F.sum("quotes") % 2).alias("odd"))
    parts = parts_of(spark.read.option("lineSep", "\n").text(paths))
    in_file = Window.partitionBy("file").orderBy("block")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    begins = ranges.select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).alias("inside"),
                           (F.row_number().over(in_file) == 1).alias("first"))

    part = Window.partitionBy("file", "block")
    upto = part.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    here = part.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = (F.col("inside") + F.coalesce(F.sum("quotes").over(upto), F.lit(0))) % 2
    lines = lines.repartition(parts, "file", "block").join(begins, ["file", "block"]).withColumn(
        "start", F.when(inside == 0, F.col("at"))).withColumn("start", F.last("start", ignorenulls=True).over(here))
    pieces = lines.groupBy("file", "block", "start").agg(
        F.min("at").alias("at"), F.bool_or("first").alias("first"), F.sort_array(F.collect_list(F.struct("at", "line"))).alias("lines")).select(
        "file", "block", "start", F.col("first") & (F.min("at").over(part) == F.col("at")),
        (F.max("start").over(part) == F.col("start")), F.transform("lines", lambda x: x["line"])).toDF(
        "file", "block", "start", "header", "last", "lines")
    # Pieces before the first record of a range belong to the last record of the ranges before.
    edges = pieces.where("start is null or last").withColumn("owner", F.last(
        F.when(F.col("start").isNotNull(), F.struct("block", "start")), ignorenulls=True).over(
        Window.partitionBy("file").orderBy("block", F.col("start").asc_nulls_first()).rowsBetween(
            Window.unboundedPreceding, Window.currentRow)))
    over = edges.groupBy("file", "owner").agg(
        F.max("header").alias("header"),
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("block", "start", "lines"))), lambda x: x["lines"])).alias("lines"))
    whole = pieces.where("start is not null and not last").select("header", "lines").unionByName(over.select("header", "lines"))
    text = F.regexp_replace(F.array_join("lines", "\n"), "\r$", "")
    return whole.where(~F.col("header")).select(text.alias("text")).where(F.length(F.trim("text")) > 0)


def read_text_columns(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """All columns of a CSV file or folder (with headers) as text, and ``CORRUPT``: the
    text of each record that has more or fewer fields than the header."""
    options = {**OPTIONS, "encoding": encoding, "header": True}
    names = spark.read.csv(path, multiLine=True, **options).columns
    # The reader takes the first line break for the end of all lines, also one in a name.
    names = [*names[:-1], *(n.removesuffix("\r") for n in names[-1:])]
    schema = StructType([StructField(n, StringType()) for n in [*names, CORRUPT]])
    if not names:
        return spark.createDataFrame([], schema)
    # A carriage return before the last place is part of a field, if not of another kind of file.
    lone = F.instr(F.regexp_replace("line", "\r$", ""), "\r") > 0
    files = _lines(spark, path, encoding).groupBy("file").agg(F.max((F.expr(_ODD) == 1) | lone).alias("broken")).collect()
    broken = [unquote(f.file) for f in files if f.broken]
    out = None
    if len(broken) < len(files):
        plain = path if not broken else [unquote(f.file) for f in files if not f.broken]
        out = spark.read.schema(schema).csv(plain, columnNameOfCorruptRecord=CORRUPT, mode="PERMISSIVE", **options)
    if broken:
        ddl = ", ".join(f"`{n.replace('`', '``')}` string" for n in schema.names)
        parsed = F.from_csv("text", ddl, {**OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
        rows = joined_records(spark, broken, encoding).select(parsed.alias("r")).select(
            *[F.col(f"r.`{f}`") for f in schema.names])
        out = rows if out is None else out.unionByName(rows)
    return out
