"""Layer catalogue: manifests, stable keys over processes, leases, sweeping."""

import os
import subprocess
import sys

import pytest

from revcast.sources.catalogue import Catalogue
from revcast.sources.landing import frame_fingerprint, inputs_key

from conftest import SF001

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def frame(spark):
    return spark.createDataFrame([(1, "a"), (2, None)], "k int not null, v string")


def copies(root):
    return sorted(str(p.relative_to(root)) for p in root.glob("*/*/*/v-*"))


def test_a_table_is_written_once_and_read_by_its_manifest(spark, tmp_path):
    cat, calls = Catalogue(spark, str(tmp_path)), []

    def build():
        calls.append(1)
        return frame(spark)

    assert cat.open("key", "g", "t") is None
    assert cat.layer("key", "g", {"t": build})["t"].count() == 2
    again = Catalogue(spark, str(tmp_path)).layer("key", "g", {"t": build})["t"]  # a later run finds it
    assert sorted(map(tuple, again.collect())) == [(1, "a"), (2, None)] and len(calls) == 1
    assert again.schema == spark.read.parquet(f"{tmp_path}/key/g/t/*").schema
    # Another key, group or table is another copy.
    cat.land("key2", "g", "t", build), cat.land("key", "h", "t", build), cat.land("key", "g", "u", build)
    assert len(calls) == 4 and len(copies(tmp_path)) == 4
    assert not any((tmp_path / "_leases").glob("*/*.json"))


def test_copies_without_manifest_or_with_missing_files_are_not_read(spark, tmp_path):
    cat = Catalogue(spark, str(tmp_path))
    frame(spark).write.parquet(f"{tmp_path}/key/g/t/v-underway")  # complete, but no manifest yet
    assert cat.open("key", "g", "t") is None
    cat.land("key", "g", "t", lambda: frame(spark))
    (manifest,) = cat.manifests("key", "g", "t")
    assert manifest["path"] != "key/g/t/v-underway"
    victim = tmp_path / manifest["path"] / manifest["files"][0][0]
    os.remove(victim)
    assert cat.open("key", "g", "t") is None
    assert cat.land("key", "g", "t", lambda: frame(spark)).count() == 2  # written anew
    # A manifest cut short by a dying writer counts as none.
    (tmp_path / "_manifests/key/g/t/0000.json").write_text('{"path": "key')
    assert cat.open("key", "g", "t").count() == 2


def test_two_writers_leave_one_table_that_all_read(spark, tmp_path):
    cat = Catalogue(spark, str(tmp_path))

    def raced():  # another driver finishes while this one builds
        Catalogue(spark, str(tmp_path)).land("key", "g", "t", lambda: frame(spark))
        return frame(spark)

    mine = cat.land("key", "g", "t", raced)
    theirs = Catalogue(spark, str(tmp_path)).open("key", "g", "t")
    assert len(cat.manifests("key", "g", "t")) == 2
    assert sorted(mine.inputFiles()) == sorted(theirs.inputFiles())


def test_sweep_keeps_what_is_named_leased_or_young(spark, tmp_path):
    cat = Catalogue(spark, str(tmp_path))
    for key in ("old", "kept", "leased"):
        cat.land(key, "g", "t", lambda: frame(spark))
    frame(spark).write.parquet(f"{tmp_path}/kept/g/t/v-lost")  # of a driver that died
    frame(spark).write.parquet(f"{tmp_path}/dead/g/t/v-lost")
    assert cat.sweep() == {"manifests": [], "copies": []}  # may be under way
    assert cat.sweep(grace=-1)["copies"] == ["dead/g/t/v-lost", "kept/g/t/v-lost"]
    with cat.lease("leased"):
        frame(spark).write.parquet(f"{tmp_path}/leased/g/t/v-underway")
        removed = cat.sweep(keep=["kept"], older_than=-1, grace=-1)
        assert [m.split("/")[0] for m in removed["manifests"]] == ["old"] == [c.split("/")[0] for c in removed["copies"]]
        assert (tmp_path / "leased/g/t/v-underway").exists()
    assert cat.open("old", "g", "t") is None and cat.open("kept", "g", "t").count() == 2
    # A lease that ran out protects nothing, and is removed.
    with cat.lease("leased", seconds=-1):
        removed = cat.sweep(keep=["kept"], older_than=-1, grace=-1)
    assert {c.split("/")[0] for c in removed["copies"]} == {"leased"} and len(removed["copies"]) == 2
    assert [c.split("/")[0] for c in copies(tmp_path)] == ["kept"] and cat.leased() == set()
    assert cat.keys().keys() == {"kept"}


def test_keys_see_inputs_plans_and_local_values(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(9).write.parquet(path)

    def read():
        return spark.read.parquet(path)

    key = frame_fingerprint(read().where("id > 3"))
    assert key == frame_fingerprint(read().where("id > 3")) != frame_fingerprint(read().where("id > 4"))
    local = [spark.createDataFrame([(v,)], "id long") for v in (1, 2)]
    with_local = [frame_fingerprint(read().join(df, "id")) for df in local]
    assert with_local[0] != with_local[1]
    assert inputs_key({"a": read()}, 1) != inputs_key({"a": read()}, 2)
    spark.range(1).write.mode("append").parquet(path)
    assert frame_fingerprint(read().where("id > 3")) != key


SCRIPT = """
import sys
from revcast.plans.config import driver_config
from revcast.plans.pipeline import ForecastRun
from revcast.session import get_spark
from revcast.sources.driver_tables import ORDER_BASE_TABLES, DriverCatalog
spark = get_spark("local[2]", shuffle_partitions=2)
dc = DriverCatalog(spark, sys.argv[1])
run = ForecastRun({n: getattr(dc, n)() for n in ORDER_BASE_TABLES}, {}, driver_config(), dc.zero_party_date_rules(),
                  dc.zero_order_rules(), sys.argv[2])
with run.lease():
    print("ROWS", run.order_sources["billev"].count(), run.fact_key)
"""


def test_a_second_process_finds_the_layer_of_the_first(tmp_path):
    out = []
    for _ in range(2):
        done = subprocess.run([sys.executable, "-c", SCRIPT, SF001, str(tmp_path / "facts")], capture_output=True,
                              text=True, timeout=300, cwd=ROOT, env={**os.environ, "PYTHONPATH": ROOT})
        assert done.returncode == 0, done.stderr[-2000:]
        out.append(next(x for x in done.stdout.splitlines() if x.startswith("ROWS")))
        out.append(copies(tmp_path / "facts"))
    assert out[:2] == out[2:] and len(out[1]) == 1


def test_cli_sweeps_layers_of_other_runs(spark, tmp_path):
    cat = Catalogue(spark, str(tmp_path / "facts"))
    cat.land("other", "facts", "t", lambda: frame(spark))
    assert cat.sweep(keep=["mine"], older_than=86400) == {"manifests": [], "copies": []}
    assert [m.split("/")[0] for m in cat.sweep(keep=["mine"], older_than=-1)["manifests"]] == ["other"]


if __name__ == "__main__":
    pytest.main([__file__])
