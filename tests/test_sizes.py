"""What is broadcast: by the bytes that rows take in memory, not by those of compressed files."""

import re

import pytest
from pyspark.sql import functions as F

from revcast.checks.queries import QUERIES
from revcast.operators.fanout import fanout_forecast
from revcast.operators.joins import JoinSpec, anti_join, bounded_broadcast, estimated_bytes, fits_broadcast, left_enrich
from revcast.sources.catalogue import Catalogue

from conftest import SF001, rows

LIMIT = 1 << 20


@pytest.fixture
def threshold(spark):
    """Broadcasts up to ``LIMIT`` bytes, and whole paths in plans."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": str(LIMIT), "spark.sql.maxMetadataStringLength": "4000",
            "spark.sql.maxPlanStringLength": "2000000"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def packed(spark, path, n=60_000):
    """Rows that take few bytes in files and many in memory."""
    spark.range(n).select(F.col("id").alias("k"), F.lit("one long text that repeats").alias("name"),
                          (F.col("id") % 7).cast("string").alias("kind")).write.parquet(str(path), compression="zstd")
    return spark.read.parquet(str(path))


def test_a_packed_table_is_no_broadcast(spark, threshold, tmp_path):
    big, left = packed(spark, tmp_path / "big"), spark.range(100).select(F.col("id").alias("k"))
    assert estimated_bytes(big) < LIMIT and not fits_broadcast(big, LIMIT)
    assert fits_broadcast(big.where("k < 100"), LIMIT)
    found = {"left": left_enrich(left, big, "k", "k"), "salted": left_enrich(left, big, "k", "k", null_salt=8),
             "marked": left_enrich(left, big, "k", "k", broadcast=True, broadcast_ceiling=LIMIT),
             "pruned": left_enrich(left, big, "k", "k").select("k", "kind"), "anti": anti_join(left, big, "k", "k"),
             "inner": left_enrich(big, left, "k", "k", how="inner"), "bounded": left.join(bounded_broadcast(big, LIMIT), "k")}
    small = {"inner"}  # its right side is
    for name, df in found.items():
        lines = [x for x in plan(df).splitlines() if "Join " in x]
        assert ("SortMergeJoin" in "".join(lines)) == (name not in small), name
    assert rows(found["salted"]) == rows(found["left"]) and found["left"].count() == 100 and not found["anti"].count()


def test_neither_side_of_an_inner_join_is_broadcast_by_its_estimate(spark, threshold, tmp_path):
    left, right = packed(spark, tmp_path / "left"), packed(spark, tmp_path / "right", 90_000).select("k")
    assert "BroadcastHashJoin" not in plan(left_enrich(left, right, "k", "k", how="inner"))


def test_few_rows_of_long_text_are_not_small(spark, threshold, tmp_path):
    spark.range(2000).select("id", F.repeat(F.lit("x"), 5000).alias("text")).write.parquet(str(tmp_path / "t"), compression="zstd")
    df = spark.read.parquet(str(tmp_path / "t"))
    assert estimated_bytes(df) < LIMIT and not fits_broadcast(df, LIMIT) and fits_broadcast(df.select("id"), LIMIT)


def test_fanout_counts_a_large_lookup_by_shuffle(spark, threshold, tmp_path):
    """The keys of a lookup are broadcast with their numbers only if they are few."""
    big, fact = packed(spark, tmp_path / "big"), spark.range(50).select(F.col("id").alias("key"))
    chain = (JoinSpec("big", "key", "k"),)
    want = [(1, "big", 50, 50)]
    made = []
    for ceiling in (LIMIT, 64 * LIMIT):
        df = fanout_forecast(fact, {"big": big}, chain, ceiling)
        assert rows(df) == want
        made.append(fits_broadcast(big.select("k"), ceiling))
    assert made == [False, True]


def broadcast_scans(text):
    """Scans below the broadcasts of a plan (files, columns), those of hot keys left out."""
    lines = text.splitlines()
    depth = [re.search(r"[A-Za-z]", x).start() if re.search(r"[A-Za-z]", x) else 0 for x in lines]
    for i, x in enumerate(lines):
        if "BroadcastExchange" not in x:
            continue
        below = []
        for j in range(i + 1, len(lines)):
            if depth[j] <= depth[i]:
                break
            below.append(lines[j])
        scans = [s for s in below if "FileScan parquet" in s]
        if len(scans) != 1 or any("Aggregate" in s or "isnull(" in s or "Join" in s for s in below):
            continue
        path = re.search(r"Location: \w+\(\d+ paths\)\[([^\],]+)", scans[0])[1]
        columns = [re.sub(r"#\d+L?$", "", c) for c in re.search(r"FileScan parquet \[([^\]]*)\]", scans[0])[1].split(",")]
        yield path, columns


FOUND = ("crm_chain", "pipeline_tcv", "contracted_tcv", "billing_fact", "recognised_deferred", "union_by_name", "fanout_forecast",
         "enrichment_chain", "tcv_forecast", "revenue_forecast")


def test_queries_broadcast_no_large_table(spark, threshold, tmp_path, monkeypatch):
    """In no step of these queries, landed ones among them, a table over the threshold is built in
    the driver, however few bytes its files take."""
    limit = 24 * 1024
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(limit))
    old = spark.conf.get("revcast.landing.dir")
    spark.conf.set("revcast.landing.dir", str(tmp_path / "landing"))
    plans, land = [], Catalogue.land

    def spied(self, key, group, table, build):
        def made():
            df = build()
            plans.append((f"{group}/{table}", plan(df)))
            return df
        return land(self, key, group, table, made)

    monkeypatch.setattr(Catalogue, "land", spied)
    try:
        for name in FOUND:
            plans.append((name, plan(QUERIES[name](spark, SF001))))
    finally:
        spark.conf.set("revcast.landing.dir", old)
    large = {}
    for name, text in plans:
        for path, columns in broadcast_scans(text):
            if path.split("/")[-2] in ("Ref_User", "dim_dates"):  # marked as bounded, with a ceiling of their own
                continue
            n = spark.read.parquet(path).select(*columns).count()
            if n * 8 * len(columns) > limit:
                large[name] = (path, columns, n)
    assert not large
