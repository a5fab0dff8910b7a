"""Corpus pipeline: from raw documents to token ids, on the operators of
``revcast.llm``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame, which is
written as Parquet and read again as the next stage's documents. All but the
last return the columns of documents:

1. ``language_id``: documents without a letter, or without a language that the
   model can tell, go; the model is learned from the stage's documents;
2. ``near_dedup``: of each group of near-duplicates (five-word shingles,
   similarity 0.8 and more) the document of the least id stays; rows of one
   id and one text become one row (the least by the other columns), and rows
   of one id with different texts are documents of their own;
   documents without an id all stay;
3. ``decontamination``: documents with a passage of the benchmark go;
4. ``secret_scan``: findings are replaced by a mark in the text, and ``n_chars``
   (where there is one) is counted anew; all documents stay;
5. ``bpe_encode``: the text becomes token ids.

Null texts have no letter and go in the first stage. Columns beyond those of
``documents`` are carried along, but for ``n_tokens`` and ``ids``, which the
last stage replaces.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revcast.llm import bpe, decontam, langid, neardup, secrets
from revcast.llm.queries import table
from revcast.llm.text import bound_batches
from revcast.session import ensure_checkpoint_dir


def _columns(docs: DataFrame) -> list:
    """The documents' columns, whatever is in their names."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return langid.keep_identified(docs, langid.learn(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    bound_batches(spark)
    known, unknown = docs.where("doc_id is not null"), docs.where("doc_id is null")
    again = known.groupBy("doc_id").agg(F.count("*").alias("copies")).where("copies > 1").select("doc_id").checkpoint()
    if again.isEmpty():
        kept = neardup.near_duplicates(docs).where("kept and doc_id is not null").select("doc_id")
        return known.join(kept, "doc_id", "left_semi").unionByName(unknown).select(*_columns(docs))
    # Each text of a repeated id is a document of its own, under a number.
    rest = [c for name, c in zip(docs.columns, _columns(docs), strict=True) if name not in ("doc_id", "text")]
    least = known.join(again, "doc_id", "left_semi").groupBy("doc_id", "text").agg(
        F.min(F.struct(F.col("text"), *rest)).alias("row"))
    rows = known.join(again, "doc_id", "left_anti").select(*_columns(docs)).unionByName(
        least.select("doc_id", "row.*").select(*_columns(docs)))
    digest = F.unhex(F.sha2(F.concat_ws(" ", F.col("doc_id").cast("string"), F.coalesce(
        F.concat(F.lit("t"), "text"), F.lit("null"))), 256))
    rows = rows.select(digest.alias("digest"), F.struct(*_columns(docs)).alias("row")).checkpoint()
    numbers = neardup.numbered(rows.select("digest", F.col("row.doc_id").cast("long").alias("class")))
    rows = rows.join(numbers.select("digest", "id"), "digest").select("id", "row").checkpoint()
    found = neardup.near_duplicates(rows.select("id", "row.text"), key="id")
    heads = found.join(rows.select("id", "row.doc_id"), "id").groupBy("component_id").agg(
        F.min(F.struct("doc_id", "id")).alias("least")).select("least.id")
    return rows.join(heads, "id", "left_semi").select("row.*").unionByName(unknown).select(*_columns(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    clean = secrets.redact(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(kind))
                                 .otherwise(F.col("n_chars")))
    return clean.select(*_columns(docs))


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return bpe.encode_rows(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("bpe_encode", bpe_encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are a written table in
    the shared checkpoint folder, so that a lost executor costs one stage."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# Learned models and a tokenizer's merges have no SQL; tests/llm holds the
# stages against brute force.
ORACLE_SQL = None
