"""Benchmark: headline queries on the driver tables, one JSON line out.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8). Each query runs to completion into Spark's ``noop`` sink (the
whole plan executes, nothing is collected to the driver); a first small
query warms the JVM and is not timed. ``land_sources`` is the extract
phase: the role-mapped source tables are derived from the driver tables
and written to the landing layer (fresh checkpoint folder per run), which
the queries then read, as the original's forecast read its landed extracts.
``land_facts`` writes the enriched facts (CRM chain, pipeline TCV, both
attributed order facts) that the two forecasts read, as the original wrote
its full facts before the forecast step.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ("revenue_forecast", "tcv_forecast", "enrichment_chain", "crm_chain", "pipeline_tcv",
            "billing_fact", "recognised_deferred", "contracted_tcv", "po_hold_fact",
            "effective_dated_reps", "latest_offering", "column_census")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    import tempfile

    from revcast.checks.queries import QUERIES
    from revcast.plans.pipeline import land_driver_facts, land_driver_sources
    from revcast.session import get_spark

    spark = get_spark(f"local[{cpus}]", app="revcast-bench", shuffle_partitions=cpus,
                      extra={"spark.driver.memory": "16g"})
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="revcast-bench-"))
    # A fresh landing folder for this run (local bench), so the extract
    # phases are measured in full rather than found from an earlier run.
    spark.conf.set("revcast.landing.dir", tempfile.mkdtemp(prefix="revcast-bench-landing-"))
    names = [n for n in HEADLINE if n in QUERIES]
    QUERIES["fiscal_calendar"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    t0 = time.perf_counter()
    land_driver_sources(spark, sf_dir)
    times["land_sources"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    land_driver_facts(spark, sf_dir)
    times["land_facts"] = round(time.perf_counter() - t0, 3)
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
