"""Spark session and checkpoint-directory helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Session settings the plans are written for: adaptive execution (runtime
# broadcast decisions, partition coalescing, skew-join splitting), UTC
# timestamps, no UI server. Python call-site capture is off: it costs
# several JVM round trips per DataFrame call while the long enrichment
# chains are being declared, and only enriches error messages.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# On a large cluster (about 100 TB, 1000 executors) the same plans want
# scan splits of a few hundred MB and a high upper bound of shuffle
# partitions that AQE coalesces down to the advisory size; tasks then stay
# around 128-256 MB and spill little. Dimensions under the broadcast
# threshold are broadcast by the optimizer, larger ones are shuffle-joined.
CLUSTER_HINTS = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.shuffle.partitions": "20000",
}


def get_spark(master: str | None = None, app: str = "revcast", shuffle_partitions: int | None = None,
              extra: dict | None = None, cluster: bool = False) -> SparkSession:
    """A session with ``DEFAULT_CONF`` (plus ``CLUSTER_HINTS`` when
    ``cluster``); ``master``/partitions for local runs."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if cluster:
        conf.update(CLUSTER_HINTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a local session without one gets a fresh temporary folder (tests);
    on a cluster a missing setting is an error, never a machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set for this cluster")
    path = tempfile.mkdtemp(prefix="revcast-ckpt-")
    sc.setCheckpointDir(path)
    return path
