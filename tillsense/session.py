"""Session construction and cluster-safe defaults."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Defaults chosen for a large cluster; every one can be overridden by the
# caller's own configuration (``conf``) or by the cluster's spark-defaults.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # runtime-checked broadcast bound: AQE only broadcasts a side whose
    # measured size is below this, otherwise it keeps the sort-merge join
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "tillsense", conf: dict | None = None) -> SparkSession:
    """Return (or create) a session with the engine's defaults applied.

    ``master`` is only set when given (tests pass ``local[*]``); on a cluster
    the submit command decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    merged = dict(_DEFAULTS)
    merged.update(conf or {})
    for k, v in merged.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Reliable checkpoint folder: the cluster's ``spark.checkpoint.dir``.

    Only when the session has none and runs in local mode (tests) a scratch
    folder is made. A cluster session without one is an error: a folder on
    the driver's disk is not visible to executors and does not survive the
    loss of a machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS) on a cluster")
    local = tempfile.mkdtemp(prefix="tillsense-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
