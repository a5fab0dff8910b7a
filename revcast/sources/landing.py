"""Landing layer: extracts written once as parquet, read back by the plans.

The original ran in two phases: every extract was landed as a file, and
the forecast read the landed files. Here the landed tables live in the
cluster's shared checkpoint folder (``spark.checkpoint.dir``), keyed by the
input files and the version of the code that derived them, so a rerun on
the same inputs reads them instead of re-deriving them, and every forecast
plan starts from short lineage and well-split parquet. This module makes the
keys; ``catalogue`` keeps the tables.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def input_fingerprint(spark: SparkSession, paths: list[str], salt: str = "") -> str:
    """Hash of the paths, sizes and modification times of all input files,
    those in nested folders (partitions) included."""
    h = hashlib.sha1(salt.encode())
    for path in sorted(paths):
        fs, p = _fs(spark, path)
        found, it = [], fs.listFiles(p, True)
        while it.hasNext():
            st = it.next()
            found.append(f"{st.getPath().toString()}|{st.getLen()}|{st.getModificationTime()}")
        h.update("\n".join(sorted(found)).encode())
    return h.hexdigest()[:20]


# What a plan's text says of this process alone: expression ids, plan ids, objects.
_PROCESS = re.compile(r"#\d+L?|plan_id=\d+|@[0-9a-f]+|\$\$Lambda[^\s,)\]]*")


def frame_fingerprint(df: DataFrame) -> str:
    """Hash that stands for a frame's rows, the same in every process: its schema, the
    text of its plan and its input files, or (where rows do not all come from
    files) its values, summed up in one aggregate."""
    spark = df.sparkSession
    plan = _PROCESS.sub("", df._jdf.queryExecution().analyzed().toString())
    files = df.inputFiles()
    if files and not re.search("LocalRelation|LogicalRDD|ExternalRDD|OneRowRelation", plan):
        what = input_fingerprint(spark, files, salt=plan)
    else:
        value = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}))
        what = str(tuple(df.agg(F.count(F.lit(1)), F.sum(value.cast("decimal(38,0)")), F.bit_xor(value)).first()))
    return hashlib.sha1(f"{df.schema.json()}|{what}".encode()).hexdigest()


def inputs_key(frames: Mapping[str, DataFrame], *more: object) -> str:
    """Hash of named frames and of anything else that a layer depends on."""
    h = hashlib.sha1()
    for name in sorted(frames.keys()):
        h.update(f"{name}={frame_fingerprint(frames[name])}\n".encode())
    for x in more:
        h.update(repr(x).encode())
    return h.hexdigest()[:20]


def landing_base(spark: SparkSession) -> str:
    """Folder of the landed layers.

    Below ``revcast.landing.dir`` when set, else the cluster's shared
    ``spark.checkpoint.dir`` itself (so a restarted driver finds the layers
    of the same inputs and code again), else the session's checkpoint
    folder (tests, local runs).
    """
    base = (spark.conf.get("revcast.landing.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
            or ensure_checkpoint_dir(spark))
    return f"{base.rstrip('/')}/landing"
