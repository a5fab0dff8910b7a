"""The full forecast run: order and CRM sources -> two forecasts."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Mapping
from contextlib import nullcontext
from functools import cache, cached_property

from pyspark.sql import DataFrame

from ..operators.fanout import assert_growth
from ..operators.joins import auto_broadcast_bytes, fits_broadcast
from . import crm
from .attribution import attributed_fact, order_fanout
from ._lazy import LazyMap
from .config import ForecastConfig
from .orders import EXTRACT_ORDER, order_sources
from .revenue import revenue_forecast
from .tcv import tcv_forecast


class ForecastRun:
    """One forecast run over given sources; every table is a lazy DataFrame
    built on first use, so asking for one piece plans only that piece."""

    def __init__(self, order_base: Mapping[str, DataFrame], crm_objects: Mapping[str, DataFrame],
                 cfg: ForecastConfig, party_date_rules: DataFrame | None = None,
                 order_rules: DataFrame | None = None, fact_root: str | None = None,
                 fact_key: str | None = None, open_rules: DataFrame | None = None):
        self.order_base = order_base
        self.crm_objects = crm_objects
        self.cfg = cfg
        self.party_date_rules = party_date_rules
        self.order_rules = order_rules
        self.open_rules = open_rules
        # With a fact root, the source tables the forecasts read (order
        # extracts, CRM fact and references) and the enriched facts are
        # written there once and read back: every chain runs once per run,
        # and the forecasts start from short lineage. The layer's folder is
        # named by the inputs, rules, parameters and code (``fact_key`` if
        # the caller has one), so another run under the same root reads it
        # only if all of these are the same.
        self.fact_root = fact_root
        self._fact_key = fact_key

    @staticmethod
    def _spark():
        from pyspark.sql import SparkSession

        # The active session is thread-local; other threads get the default.
        return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()

    def _layer(self, group: str, builders: dict) -> Mapping[str, DataFrame]:
        if self.fact_root is None:
            return LazyMap(builders)
        return self.catalogue.layer(self.fact_key, group, builders)

    @cached_property
    def catalogue(self):
        """The fact layers below the fact root."""
        from ..sources.catalogue import Catalogue

        return Catalogue(self._spark(), self.fact_root)

    def lease(self):
        """Keeps the run's fact layer from being swept while it is in use."""
        return nullcontext() if self.fact_root is None else self.catalogue.lease(self.fact_key)

    @cached_property
    def fact_key(self) -> str:
        from ..sources.landing import inputs_key

        if self._fact_key:
            return self._fact_key
        frames = {f"order/{n}": self.order_base[n] for n in self.order_base.keys()}
        frames.update({f"crm/{n}": self.crm_objects[n] for n in self.crm_objects.keys()})
        rules = {"party_date": self.party_date_rules, "order": self.order_rules, "open": self.open_rules}
        frames.update({f"rules/{n}": df for n, df in rules.items() if df is not None})
        return inputs_key(frames, self.cfg, _code_version())

    @cached_property
    def order_sources(self) -> Mapping[str, DataFrame]:
        return order_sources(self.order_base, self.cfg, self.party_date_rules, self.order_rules,
                             wrap=lambda b: self._layer("order_sources", b), open_rules=self.open_rules)

    @cached_property
    def crm_prefixed(self) -> dict[str, DataFrame]:
        return crm.prefixed(self.crm_objects)

    @cached_property
    def crm_layer(self) -> Mapping[str, DataFrame]:
        """CRM fact, pipeline TCV and the prepared references."""
        cat = self.crm_prefixed
        return self._layer("crm_sources", {
            "Fact_Trx": lambda: crm.transaction_fact(self.crm_objects, profile=self._profile("Fact_Trx")),
            "Fact_Tcvpl": lambda: crm.pipeline_tcv(self.crm_layer["Fact_Trx"]),
            "Ref_BillParty": lambda: crm.bill_party_ref(cat["Ref_Acct"]),
            "Ref_Prnt": lambda: crm.parent_ref(cat["Ref_Prnt"]),
            "Ref_Offr": lambda: crm.offering_ref(cat["Ref_Offr"]),
            "Ref_Opps": lambda: crm.opportunity_ref(cat["Ref_Opps"]),
            "Ref_Opps_Acct": lambda: crm.opportunity_account_ref(self.crm_objects["Ref_Opps_Acct"]),
        })

    def _profile(self, name: str) -> float:
        """The part of a CRM table whose keys are sketched: none where it is not written, or
        small enough to broadcast."""
        fact = self.crm_objects[name]
        return self.cfg.profile_fraction if self.fact_root and not fits_broadcast(fact, auto_broadcast_bytes(fact)) else 0.0

    @property
    def fact_trx(self) -> DataFrame:
        return self.crm_layer["Fact_Trx"]

    @property
    def fact_tcvpl(self) -> DataFrame:
        return self.crm_layer["Fact_Tcvpl"]

    @cached_property
    def crm_refs(self) -> dict[str, DataFrame]:
        """The CRM reference tables the order chain reads (prepared)."""
        cat = self.crm_prefixed
        refs = {"Ref_Acct": cat["Ref_Acct"], "Ref_User": cat["Ref_User"]}
        refs.update({n: self.crm_layer[n] for n in ("Ref_BillParty", "Ref_Prnt", "Ref_Offr", "Ref_Opps",
                                                    "Ref_Opps_Acct")})
        return refs

    def _attributed(self, name: str) -> DataFrame:
        # Written tables only are sketched: derived ones would be derived twice.
        return attributed_fact(name, self.order_sources, self.crm_refs, broadcast_ceiling=self.cfg.broadcast_ceiling,
                               profile=self.cfg.profile_fraction if self.fact_root else 0.0)

    @cached_property
    def fact_layer(self) -> Mapping[str, DataFrame]:
        """The two attributed order facts."""
        return self._layer("facts", {"rev_attributed": lambda: self._attributed("revfact"),
                                     "tcv_attributed": lambda: self._attributed("tcv")})

    @property
    def attributed(self) -> tuple[DataFrame, DataFrame]:
        return self.fact_layer["rev_attributed"], self.fact_layer["tcv_attributed"]

    @cached_property
    def fcrev(self) -> DataFrame:
        return revenue_forecast(self.fact_layer["rev_attributed"], self.fact_trx, self.cfg)

    @cached_property
    def fctcv(self) -> DataFrame:
        return tcv_forecast(self.fact_layer["tcv_attributed"], self.fact_tcvpl, self.crm_refs["Ref_Opps"], self.cfg)

    def tables(self) -> dict[str, DataFrame]:
        """Every intermediate and final table (plans all of them)."""
        out: dict[str, DataFrame] = {**self.crm_prefixed.materialise(), **self.crm_refs}
        out.update({k: self.order_sources[k] for k in self.order_sources.keys()})
        out.update({"Fact_Trx": self.fact_trx, "Fact_Tcvpl": self.fact_tcvpl,
                    "rev_attributed": self.attributed[0], "tcv_attributed": self.attributed[1],
                    "fcrev": self.fcrev, "fctcv": self.fctcv})
        return out


def build_forecasts(order_base: Mapping[str, DataFrame], crm_objects: Mapping[str, DataFrame],
                    cfg: ForecastConfig, party_date_rules: DataFrame | None = None,
                    order_rules: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every intermediate and final table of one run, as lazy DataFrames:
    the order-side tables, the CRM tables, ``rev_attributed`` /
    ``tcv_attributed`` and the forecasts ``fcrev`` and ``fctcv``."""
    return ForecastRun(order_base, crm_objects, cfg, party_date_rules, order_rules).tables()


@cache
def _code_version() -> str:
    """Hash of the package's source files, but for the training-data operators,
    which no layer depends on: any other code change lands fresh layers."""
    import hashlib
    import os

    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    h = hashlib.sha1()
    for dirpath, _, files in sorted(os.walk(here)):
        if os.path.relpath(dirpath, here).split(os.sep)[0] == "llm":
            continue
        for f in sorted(files):
            if f.endswith(".py"):
                h.update(os.path.relpath(os.path.join(dirpath, f), here).encode())
                with open(os.path.join(dirpath, f), "rb") as fh:
                    h.update(fh.read())
    return h.hexdigest()[:16]


def driver_run(spark, sf_dir: str, cfg: ForecastConfig | None = None, landed: bool = True,
               facts: bool = False, prefetch: bool = False, parallel_jobs: int = 4) -> ForecastRun:
    """A ``ForecastRun`` over the driver tables (role mapping).

    With ``landed`` (the default) the derived source tables are written
    once to the landing layer under the shared checkpoint folder and read
    back from there, like the extract files of the original; with
    ``facts`` the order extracts, CRM tables and attributed facts too.
    A table is written when it is first asked for; ``prefetch`` writes them
    all up front, ``parallel_jobs`` at a time.
    """
    from ..sources.driver_tables import ORDER_BASE_TABLES, TABLES, DriverCatalog
    from ..sources.catalogue import Catalogue
    from ..sources.landing import input_fingerprint, landing_base

    dc = DriverCatalog(spark, sf_dir, cfg)
    base_b = {n: getattr(dc, n) for n in ORDER_BASE_TABLES}
    objs_b = dc.crm_builders()
    if landed:
        key = input_fingerprint(spark, [f"{sf_dir}/{t}.parquet" for t in TABLES],
                                salt=_code_version() + repr(dc.p))
        root = landing_base(spark)
        catalogue = Catalogue(spark, root)
        base, objs = catalogue.layer(key, "order", base_b), catalogue.layer(key, "crm", objs_b)
        fact_root = root if facts else None
    else:
        base, objs = LazyMap(base_b), LazyMap(objs_b)
        key = fact_root = None
    run = ForecastRun(base, objs, dc.p, dc.zero_party_date_rules(), dc.zero_order_rules(), fact_root,
                      fact_key=key)  # of inputs, parameters and code
    if landed and prefetch:
        _prefetch(run, facts, parallel_jobs)
    return run


def _parallel_get(jobs, parallel_jobs: int) -> None:
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max(1, parallel_jobs)) as pool:
        list(pool.map(lambda job: job[0][job[1]], jobs))


def _prefetch(run: ForecastRun, facts: bool, parallel_jobs: int) -> None:
    """Land every table of the run's layers now, several write jobs at a
    time (tables already landed are only checked). Tables that read other
    tables wait on the landing lock of those."""
    _parallel_get([(run.order_base, n) for n in run.order_base.keys()]
                  + [(run.crm_objects, n) for n in run.crm_objects.keys()], parallel_jobs)
    if facts:
        osrc, clay = run.order_sources, run.crm_layer
        _parallel_get([(osrc, n) for n in osrc.keys()] + [(clay, n) for n in clay.keys()], parallel_jobs)
        _parallel_get([(run.fact_layer, n) for n in ("rev_attributed", "tcv_attributed")], 2)


def land_driver_facts(spark, sf_dir: str, cfg: ForecastConfig | None = None,
                      parallel_jobs: int = 4) -> ForecastRun:
    """Write the sources and the fact layers of ``driver_run`` now."""
    return driver_run(spark, sf_dir, cfg, facts=True, prefetch=True, parallel_jobs=parallel_jobs)


def land_driver_sources(spark, sf_dir: str, cfg: ForecastConfig | None = None,
                        parallel_jobs: int = 4) -> ForecastRun:
    """Write every landed source of ``driver_run`` now (the extract phase)."""
    return driver_run(spark, sf_dir, cfg, prefetch=True, parallel_jobs=parallel_jobs)


def driver_forecasts(spark, sf_dir: str, cfg: ForecastConfig | None = None) -> dict[str, DataFrame]:
    """``build_forecasts`` over the driver tables (role mapping)."""
    return driver_run(spark, sf_dir, cfg).tables()


def check_growth(run: ForecastRun, most: float) -> None:
    """Raise before the order chains run, if a step of theirs would make more
    than ``most`` times the rows of one of the facts."""
    catalog = ChainMap(run.order_sources, run.crm_refs)
    for name in ("revfact", "tcv"):
        assert_growth(order_fanout(run.order_sources[name], catalog), most)


def write_forecasts(run: ForecastRun, out_root: str, snapshot_date, facts: bool = True,
                    layers: bool = False, max_growth: float | None = None) -> dict[str, str]:
    """Write the enriched facts (layer ``fact``) and the two
    forecasts as the ``snapshot_date`` partition of ``fc`` and ``tcv``.

    Only that day's partition is replaced; earlier snapshots stay. Each fact
    is written once and read back, and both forecasts are built from the
    files. ``layers`` also writes the full pulls (``raw``) and the curated
    order and CRM tables (``source``, the order extracts in their orders). The run's fact layer is under a lease
    meanwhile. With ``max_growth`` the run ends before the order chains, if one of
    their joins would multiply the rows by more than that.
    """
    with run.lease():
        if max_growth is not None:
            check_growth(run, max_growth)
        return _write_forecasts(run, out_root, snapshot_date, facts, layers)


def _write_forecasts(run: ForecastRun, out_root: str, snapshot_date, facts: bool, layers: bool) -> dict[str, str]:
    from ..sources.sinks import write_layer, write_snapshot

    paths: dict[str, str] = {}
    if layers:
        paths.update(write_layer({n: run.crm_objects[n] for n in run.crm_objects.keys()}, out_root, "raw"))
        paths.update(write_layer({**{n: run.order_sources[n] for n in run.order_sources.keys()},
                                  **{n: df for n, df in run.crm_refs.items()}}, out_root, "source",
                                 order=EXTRACT_ORDER))
    fcrev, fctcv = (run.fcrev, run.fctcv) if not facts else (None, None)
    if facts:
        made = write_layer({"fullcrm_revfacts": run.fact_trx}, out_root, "fact")
        spark = run._spark()
        trx = spark.read.parquet(made["fullcrm_revfacts"])
        made.update(write_layer({"fullorder_revfacts": run.attributed[0],
                                 "fullorder_tcvfacts": run.attributed[1],
                                 "fullcrm_tcvfacts": crm.pipeline_tcv(trx)}, out_root, "fact"))
        back = {n: spark.read.parquet(p) for n, p in made.items()}
        fcrev = revenue_forecast(back["fullorder_revfacts"], trx, run.cfg)
        fctcv = tcv_forecast(back["fullorder_tcvfacts"], back["fullcrm_tcvfacts"], run.crm_refs["Ref_Opps"], run.cfg)
        paths.update(made)
    paths["fc"] = write_snapshot(fcrev, f"{out_root}/forecast/fc", snapshot_date)
    paths["tcv"] = write_snapshot(fctcv, f"{out_root}/forecast/tcv", snapshot_date)
    return paths
