"""Run both forecasts from landed source tables and write a dated snapshot.

    python -m revcast --order-dir DIR --crm-dir DIR --out DIR --snapshot-date 2024-06-30 \\
        [--as-of "2024-06-30 12:00:00"] [--config cfg.json] [--fact-root DIR]
        [--format parquet|csv] [--sweep-days N]
        [--quarantine DIR] [--max-growth X]

``--order-dir`` holds one table per order-system base table and
``--crm-dir`` one per CRM object (names as in FIXTURES.md), plus optional
``zero_party_dates`` / ``zero_orders`` / ``zero_rules`` (open fields are null) rule
tables among the order tables.
The forecasts are written under ``--out/forecast/{fc,tcv}`` as the
``snapshot_date`` partition, and the enriched facts under ``--out/fact``.
``--config`` is a JSON object of ``ForecastConfig`` fields (cut-over
periods, exclusion lists, ...); ``--as-of`` overrides its ``as_of``. A later
run with the same inputs, parameters and code reads the tables below
``--fact-root`` again; ``--sweep-days`` removes those of other runs that are
older and in nobody's use. A broken CSV record ends the run; with
``--quarantine`` such records go to a table there, and the run ends only if kept and
rejected ones don't add up to those read. ``--max-growth`` ends the run before the
order facts are enriched, if a join would multiply their rows by more than that.
"""

from __future__ import annotations

import argparse
import dataclasses
import json

from pyspark import SparkConf

from .plans.config import ForecastConfig
from .plans.pipeline import ForecastRun, write_forecasts
from .session import get_spark
from .sources.readers import load_directory
from .sources.rejects import Quarantine
from .sources.schemas import crm_schemas, order_schemas


def main(argv=None, spark=None) -> dict[str, str]:
    ap = argparse.ArgumentParser(prog="revcast")
    ap.add_argument("--order-dir", required=True, help="one table per order-system base table")
    ap.add_argument("--crm-dir", required=True, help="one table per CRM object")
    ap.add_argument("--out", required=True, help="output root (fact layer and forecast snapshots)")
    ap.add_argument("--snapshot-date", required=True, help="snapshot partition to write, YYYY-MM-DD")
    ap.add_argument("--as-of", default=None, help="point in time replacing the database clock")
    ap.add_argument("--config", default=None, help="JSON object of ForecastConfig fields")
    ap.add_argument("--fact-root", default=None, help="shared folder for the fact layer (written once)")
    ap.add_argument("--format", default="parquet", choices=("parquet", "csv"), help="format of the input tables")
    ap.add_argument("--layers", action="store_true", help="also write the full pulls and the curated sources")
    ap.add_argument("--sweep-days", type=float, default=None, help="then remove fact layers older than so many days")
    ap.add_argument("--quarantine", default=None, help="folder for the records of CSV inputs that can't be read")
    ap.add_argument("--max-growth", type=float, default=None, help="most rows a join may make of one, on average")
    a = ap.parse_args(argv)
    local = SparkConf().get("spark.master", "local[*]").startswith("local")
    spark = spark or get_spark(cluster=not local)
    aside = {"order": None, "crm": None}
    if a.quarantine:
        aside = {side: Quarantine(spark, f"{a.quarantine.rstrip('/')}/{side}") for side in aside}
    how = {side: {"on_reject": "quarantine" if q else "fail", "quarantine": q} for side, q in aside.items()}
    order = load_directory(spark, a.order_dir, order_schemas(), fmt=a.format, **how["order"])
    crm_objs = load_directory(spark, a.crm_dir, crm_schemas(), fmt=a.format, **how["crm"])
    for q in filter(None, aside.values()):
        q.reconcile()
    fields = {}
    if a.config:
        with open(a.config) as fh:
            fields = json.load(fh)
        fields = {k: tuple(v) if isinstance(v, list) else v for k, v in fields.items()}
    if a.as_of:
        fields["as_of"] = a.as_of
    cfg = dataclasses.replace(ForecastConfig(), **fields)
    run = ForecastRun(order, crm_objs, cfg, order.get("zero_party_dates"), order.get("zero_orders"),
                      fact_root=a.fact_root, open_rules=order.get("zero_rules"))
    paths = write_forecasts(run, a.out, a.snapshot_date, layers=a.layers, max_growth=a.max_growth)
    if a.fact_root and a.sweep_days is not None:
        run.catalogue.sweep(keep=[run.fact_key], older_than=a.sweep_days * 86400)
    return paths


if __name__ == "__main__":
    print(main())
