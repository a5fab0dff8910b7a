"""Catalogue of landed layers: manifests written last, leases, mark and sweep.

Below one shared root (any Hadoop file system):

* ``<key>/<group>/<table>/v-<id>/``: the part files of one written copy;
* ``_manifests/<key>/<group>/<table>/<id>.json``: written after the copy is
  complete, with its files, their sizes and its schema. Only what a manifest
  names is ever read, so an interrupted copy is never seen; of several copies
  (two drivers at once) all readers take the first by name. Nothing is renamed;
* ``_leases/<key>/<id>.json``: who reads or writes a key, and until when.

The key stands for all that a layer depends on (``landing.inputs_key``): the
same in every process, so a later run opens what an earlier one wrote. A table
is opened with the schema of its manifest, without a job that reads footers.

``sweep`` removes keys that nobody wants and copies that no manifest names:
the manifest goes first, then the data; keys under a lease are left alone, and
so are copies younger than a grace time, which may be under way.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..plans._lazy import LazyMap

LEASE_SECONDS = 24 * 3600
GRACE_SECONDS = 24 * 3600
# Landed tables are written once and read a few times: fewer bytes count more than speed.
COMPRESSION = "zstd"


class Catalogue:
    """The landed layers below one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # ------------------------------------------------------------- small files
    def _write(self, path: str, value: dict) -> None:
        out = self._fs.create(self._path(path), False)
        try:
            out.write(bytearray(json.dumps(value).encode()))
        finally:
            out.close()

    def _read(self, path: str) -> dict | None:
        """A small file's value; None where it has gone or is not all there."""
        try:
            stream = self._fs.open(self._path(path))
            try:
                return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            finally:
                stream.close()
        except Exception as e:  # noqa: BLE001  py4j wraps every Java exception
            if isinstance(e, json.JSONDecodeError) or "FileNotFoundException" in str(e):
                return None
            raise

    def _list(self, path: str) -> list[tuple[str, bool, int, int]]:
        """Entries of a folder: name, whether a folder, size, modification time (ms)."""
        p = self._path(path)
        if not self._fs.exists(p):
            return []
        return sorted((s.getPath().getName(), s.isDirectory(), s.getLen(), s.getModificationTime())
                      for s in self._fs.listStatus(p))

    def _below(self, path: str, depth: int) -> Iterator[str]:
        """Paths of the entries so many folders below, relative to ``path``."""
        for name, folder, _, _ in self._list(path):
            if depth == 1:
                yield name
            elif folder:
                yield from (f"{name}/{x}" for x in self._below(f"{path}/{name}", depth - 1))

    # ------------------------------------------------------------------ tables
    def manifests(self, key: str, group: str, table: str) -> list[dict]:
        """The manifests of a table whose files are all there, by name."""
        folder = f"{self.root}/_manifests/{key}/{group}/{table}"
        out = []
        for name, _, _, _ in self._list(folder):
            value = self._read(f"{folder}/{name}")
            if value is None:
                continue
            sizes = {f: n for f, is_folder, n, _ in self._list(f"{self.root}/{value['path']}") if not is_folder}
            if all(sizes.get(f) == n for f, n in value["files"]):
                out.append(value)
        return out

    def open(self, key: str, group: str, table: str) -> DataFrame | None:
        """The landed table, or None."""
        found = self.manifests(key, group, table)
        if not found:
            return None
        schema = StructType.fromJson(found[0]["schema"])
        return self.spark.read.schema(schema).parquet(f"{self.root}/{found[0]['path']}")

    def land(self, key: str, group: str, table: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The landed table, written now if it is not there."""
        found = self.open(key, group, table)
        if found is not None:
            return found
        name = uuid.uuid4().hex
        path = f"{key}/{group}/{table}/v-{name}"
        with self.lease(key):
            df = build()
            df.write.parquet(f"{self.root}/{path}", compression=COMPRESSION)
            files = [[f, n] for f, folder, n, _ in self._list(f"{self.root}/{path}")
                     if not folder and not f.startswith((".", "_"))]
            # As the files have it: every column of a file can be null.
            schema = json.loads(df.schema.json())
            for field in schema["fields"]:
                field["nullable"] = True
            self._write(f"{self.root}/_manifests/{key}/{group}/{table}/{name}.json",
                        {"path": path, "files": files, "schema": schema, "made": int(time.time() * 1000)})
            found = self.open(key, group, table)
        if found is None:
            raise RuntimeError(f"{path}: files of a written copy are missing")
        return found

    def layer(self, key: str, group: str, builders: Mapping[str, Callable[[], DataFrame]]) -> LazyMap:
        """Name -> landed table, each written on first use unless it is there
        already. Safe to use from several driver threads: one of them writes."""
        locks = {n: threading.Lock() for n in builders}

        def loader(name: str, build: Callable[[], DataFrame]) -> Callable[[], DataFrame]:
            def load() -> DataFrame:
                with locks[name]:
                    return self.land(key, group, name, build)
            return load

        return LazyMap({n: loader(n, b) for n, b in builders.items()})

    # ------------------------------------------------------ leases and sweeping
    @contextmanager
    def lease(self, key: str, seconds: int = LEASE_SECONDS) -> Iterator[None]:
        """Keep ``sweep`` off a key while it is read or written, at most so long
        (a driver that dies gives nothing back)."""
        path = f"{self.root}/_leases/{key}/{uuid.uuid4().hex}.json"
        self._write(path, {"until": int((time.time() + seconds) * 1000)})
        try:
            yield
        finally:
            self._fs.delete(self._path(path), False)

    def leased(self) -> set[str]:
        """Keys under a lease that has not run out; leases that have are removed."""
        now, out = time.time() * 1000, set()
        for path in self._below(f"{self.root}/_leases", 2):
            value = self._read(f"{self.root}/_leases/{path}")
            if value is not None and value["until"] < now:
                self._fs.delete(self._path(f"{self.root}/_leases/{path}"), False)
            else:  # one being written counts too
                out.add(path.split("/")[0])
        return out

    def keys(self) -> dict[str, int]:
        """Each key that has a manifest, and when its last one was made (ms)."""
        out: dict[str, int] = {}
        for path in self._below(f"{self.root}/_manifests", 4):
            value = self._read(f"{self.root}/_manifests/{path}")
            if value is not None:
                key = path.split("/")[0]
                out[key] = max(out.get(key, 0), value["made"])
        return out

    def sweep(self, keep: Iterable[str] = (), older_than: float | None = None,
              grace: float = GRACE_SECONDS) -> dict[str, list[str]]:
        """Mark and sweep; returns the ``manifests`` and ``copies`` removed.

        Wanted are the keys in ``keep``, those under a lease and, with
        ``older_than`` (seconds), those made since; without it every key is wanted and
        only copies that no manifest names go (those older than ``grace``)."""
        now = time.time() * 1000
        leased = self.leased()
        wanted = {k for k, made in self.keys().items()
                  if older_than is None or made >= now - older_than * 1000} | set(keep) | leased
        removed: dict[str, list[str]] = {"manifests": [], "copies": []}
        named = set()
        for path in list(self._below(f"{self.root}/_manifests", 4)):
            key = path.split("/")[0]
            value = self._read(f"{self.root}/_manifests/{path}")
            if value is not None and key in wanted:
                named.add(value["path"])
            elif key not in wanted:
                self._fs.delete(self._path(f"{self.root}/_manifests/{path}"), False)
                removed["manifests"].append(path)
        unwanted = {p.split("/")[0] for p in removed["manifests"]}
        for key, folder, _, _ in self._list(self.root):
            if not folder or key.startswith("_") or key in leased:
                continue
            for path in list(self._below(f"{self.root}/{key}", 3)):
                copy = f"{key}/{path}"
                made = self._fs.getFileStatus(self._path(f"{self.root}/{copy}")).getModificationTime()
                if copy not in named and (key in unwanted or made < now - grace * 1000):
                    self._fs.delete(self._path(f"{self.root}/{copy}"), True)
                    removed["copies"].append(copy)
        return removed
