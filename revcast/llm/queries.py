"""The registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from revcast.session import ensure_checkpoint_dir

from .text import bound_batches


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; sees to the session's checkpoint folder and batch size."""
    ensure_checkpoint_dir(spark)
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import license_report

    return license_report(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import secret_report

    return secret_report(table(spark, sf_dir, "documents"))


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import round_trip

    return round_trip(table(spark, sf_dir, "documents"))


def op4_quality_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import grade_documents

    return grade_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import language_report

    return language_report(table(spark, sf_dir, "documents"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .urls import hosts_with_words, judge_urls

    pages = table(spark, sf_dir, "pages")
    return judge_urls(pages, listed=hosts_with_words(pages))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .tokencounts import line_report

    return line_report(table(spark, sf_dir, "documents"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprints import compare_with_neighbours

    return compare_with_neighbours(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import contamination_report

    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .merkle import tampering_report

    return tampering_report(table(spark, sf_dir, "documents"))


def op12_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mixture_report

    return mixture_report(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .spelling import variants

    return variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_secret_scan": op2_secret_scan,
    "op3_bpe_codec": op3_bpe_codec,
    "op4_quality_grades": op4_quality_grades,
    "op5_language_id": op5_language_id,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_url_filter": op7_url_filter,
    "op8_token_counts": op8_token_counts,
    "op9_fingerprints": op9_fingerprints,
    "op10_decontamination": op10_decontamination,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_source_mixture": op12_source_mixture,
    "op13_spelling_variants": op13_spelling_variants,
}
