"""Spark session set-up shared by tests, bench and the driver entry points."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC session zone (timestamps are kept as
# TIMESTAMP_NTZ until serialisation), AQE for runtime re-planning and skew
# splits, and no web UI.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Broadcasts are size-checked: at planning time against file-size
    # estimates (kept at Spark's small default, as compressed parquet
    # understates the in-memory size), at run time by AQE against the
    # measured shuffle size of the side. Larger sides stay on sort-merge join.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoints of the batch index are removed once no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "fleetlake", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a local session with the package defaults."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("FLEETLAKE_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is (unset there is an error). Only in local mode, when it is unset
    (local runs and tests), a fresh scratch folder is created here.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            # executors on other machines cannot read a folder local to the driver
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="fleetlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
