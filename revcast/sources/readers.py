"""Sources: order-system SQL extracts, CRM export files, landed tables.

The original pulled every extract into one process (cursor ``fetchall``,
paged API client). Here each source is a lazy DataFrame with an explicit
schema; the database or the export files are read in parallel by the
executors.
"""

from __future__ import annotations

import datetime as _dt
import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .csv_records import CORRUPT, read_text_columns
from .rejects import Quarantine, split_rows


def sql_literal(value) -> str:
    """A value as SQL text."""
    if isinstance(value, _dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, _dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def range_predicates(column: str, bounds: Sequence) -> list[str]:
    """Predicates that cut a table into ranges of a column at ``bounds`` (ascending; each is
    the least value of its range): the nulls first, in a range of their own, then one range
    before the first bound and one from each bound to the next. Each row is in exactly one."""
    texts = [sql_literal(b) for b in bounds]
    out = [f"{column} IS NULL"]
    if not texts:
        return [*out, f"{column} IS NOT NULL"]
    out.append(f"{column} < {texts[0]}")
    out += [f"{column} >= {lo} AND {column} < {hi}" for lo, hi in zip(texts, texts[1:])]
    return [*out, f"{column} >= {texts[-1]}"]


def range_bounds(df: DataFrame, column: str, n: int) -> list:
    """Bounds of about ``n`` ranges of equally many rows: the quantiles of the column's
    non-null values, each value once (a value that fills several ranges is one bound). One
    aggregate, of a mergeable sketch. For text, which the sketch does not take, the
    quantiles of a bounded sample of its values with their counts."""
    kind = df.schema[column].dataType
    values = df.where(F.col(f"`{column}`").isNotNull()).select(F.col(f"`{column}`").alias("v"))
    shares = [i / n for i in range(1, n)]
    if not shares:
        return []
    if isinstance(kind, StringType):  # at most 64 values a range, the same ones each time
        rows = values.groupBy("v").agg(F.count(F.lit(1)).alias("k")).orderBy(F.xxhash64("v")).limit(64 * n).collect()
        rows = sorted((r.v, r.k) for r in rows)
        total, seen, out = sum(k for _, k in rows), 0, []
        for v, k in rows:
            if len(out) < len(shares) and seen >= shares[len(out)] * total:
                out.append(v)
            seen += k
        return sorted(set(out))
    found = values.agg(F.percentile_approx("v", shares, 100 * n).alias("q")).first()["q"] or []
    return sorted(set(found))


def read_ranges(df: DataFrame, column: str, n: int) -> list[DataFrame]:
    """A frame cut into ranges of a column (``range_bounds``), nulls in the first."""
    return [df.where(p) for p in range_predicates(f"`{column}`", range_bounds(df, column, n))]


def read_sql_extract(spark: SparkSession, url: str, sql: str, properties: Mapping[str, str],
                     partition_column: str | None = None, lower_bound: int | None = None,
                     upper_bound: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Run ``sql`` on a JDBC database and return its rows.

    Connection details (user, password, driver) come from ``properties``.
    With ``partition_column`` and bounds, Spark issues ``num_partitions``
    range queries in parallel instead of one cursor. Without bounds the database is
    asked for those of equally filled ranges first (``bounds_query``), and nulls
    are a range of their own.
    """
    if partition_column is not None and lower_bound is None:
        bounds = _jdbc(spark, url, bounds_query(sql, partition_column, num_partitions or 8), properties).load()
        bounds = sorted(r[0] for r in bounds.collect())  # one row a range
        return spark.read.jdbc(url, f"({sql}) q", predicates=range_predicates(partition_column, bounds[1:]),
                               properties=dict(properties))
    reader = _jdbc(spark, url, sql, properties)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower_bound).option("upperBound", upper_bound)
                  .option("numPartitions", num_partitions or 1))
    return reader.load()


def _jdbc(spark: SparkSession, url: str, sql: str, properties: Mapping[str, str]):
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", f"({sql}) q")
    for k, v in properties.items():
        reader = reader.option(k, v)
    return reader


def bounds_query(sql: str, column: str, n: int) -> str:
    """SQL of the least value of each of ``n`` equally filled ranges of a query's column."""
    return (f"SELECT MIN(v) AS v FROM (SELECT {column} AS v, NTILE({n}) OVER (ORDER BY {column}) AS t "
            f"FROM ({sql}) x WHERE {column} IS NOT NULL) y GROUP BY t")


def read_sql_extracts(spark: SparkSession, specs: Mapping[str, Mapping]) -> dict[str, DataFrame]:
    """S1 over a config: ``name -> {url?, sql, properties, finalcols?}``.

    With a ``url`` the SQL runs in that database (JDBC). Without one it runs
    in Spark itself over the temporary views the caller registered (the
    base tables already landed in the lake). ``finalcols``, when given, is
    applied as a strict projection (P1): a missing column is an error.
    """
    out = {}
    for name, spec in specs.items():
        if spec.get("url"):
            df = read_sql_extract(spark, spec["url"], spec["sql"], spec.get("properties", {}),
                                  spec.get("partition_column"), spec.get("lower_bound"),
                                  spec.get("upper_bound"), spec.get("num_partitions"))
        else:
            df = spark.sql(spec["sql"])
        if spec.get("finalcols"):
            df = df.select(*[F.col(f"`{c}`") for c in spec["finalcols"]])
        out[name] = df
    return out


def read_crm_export(spark: SparkSession, path: str, schema: StructType,
                    prefix: str | None = None, drop=("attributes",), on_reject: str = "fail",
                    quarantine: Quarantine | None = None, source: str | None = None) -> DataFrame:
    """CRM object records landed as JSON lines (one record per line).

    The per-record ``attributes`` struct is dropped and every column gains
    ``prefix`` (P5), as the original did after each API pull. A line that is no
    record of this schema ends the job, or goes to the ``quarantine`` under the name
    ``source`` (``on_reject``, see ``rejects``).
    """
    if (on_reject == "quarantine") != (quarantine is not None):
        raise ValueError("on_reject='quarantine' goes with a quarantine")
    whole = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    read = spark.read.schema(whole).json(path, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    df, rejected = split_rows(read, CORRUPT, None, on_reject)
    if rejected is not None:
        df = quarantine.add(source or os.path.basename(path.rstrip("/")), read, df, rejected)
    df = df.drop(*[d for d in drop if d in df.columns])
    if prefix:
        df = df.toDF(*[prefix + c for c in df.columns])
    return df


def flatten_parent(df: DataFrame, key: str, parent: str, parent_field: str = "Id",
                   key_alias: str | None = None, parent_alias: str | None = None) -> DataFrame:
    """S3: pull ``parent.parent_field`` out of a nested parent record.

    A null parent gives a null id (the original wrote the text 'None',
    which then blocked the account fallback). In a flat file the parent's
    column holds the id itself, or both columns have their final names.
    """
    key_name, parent_name = key_alias or key, parent_alias or f"{parent}_{parent_field}"
    if parent not in df.columns and parent_name in df.columns:
        return df.select(key_name, parent_name)
    nested = isinstance(df.schema[parent].dataType, StructType)
    return df.select(F.col(key).alias(key_name),
                     F.col(f"{parent}.{parent_field}" if nested else parent).alias(parent_name))


def _list_names(spark: SparkSession, path: str) -> list[str]:
    """Entry names of a directory on any Hadoop file system (local, HDFS,
    object stores); only the listing goes through the driver."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(st.getPath().getName() for st in fs.listStatus(p))


def load_directory(spark: SparkSession, path: str, schemas: Mapping[str, StructType] | None = None,
                   fmt: str = "parquet", skip=("hist",), encoding: str = "ISO-8859-1", on_reject: str = "fail",
                   quarantine: Quarantine | None = None) -> dict[str, DataFrame]:
    """Every entry of a directory becomes a table named after it.

    Entries named in ``skip`` are ignored. CSV is read with a header and
    ISO-8859-1, as dataframe libraries write it: a doubled quote stands for
    a quote, and fields may hold separators and line breaks, over which large
    files are split all the same (``csv_records``). Its columns are matched with
    the schema by name and cast; columns without one are text. Rows with too
    many or too few fields, or a text that can't be cast, end the job or go to
    the ``quarantine`` (``on_reject``, see ``rejects``). Listing the directory is
    metadata only; the data is read by the executors.
    """
    if (on_reject == "quarantine") != (quarantine is not None):
        raise ValueError("on_reject='quarantine' goes with a quarantine")
    out = {}
    for entry in _list_names(spark, path):
        name = os.path.splitext(entry)[0]
        if entry in skip or name in skip or entry.startswith((".", "_")):
            continue
        full = os.path.join(path, entry)
        if fmt == "csv":
            read = read_text_columns(spark, full, encoding)
            out[name], rejected = split_rows(read, CORRUPT, (schemas or {}).get(name), on_reject)
            if rejected is not None:
                out[name] = quarantine.add(name, read, out[name], rejected)
        else:
            out[name] = spark.read.format(fmt).load(full)
    return out
