"""Session construction and session-level settings.

Everything here is configuration a Spark user sets; nothing overrides Spark
internals.  ``ensure_session_defaults`` only fills settings that are unset, so
a cluster's own choices (shuffle partitions, checkpoint dir) win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every pipeline relies on for correct results.
REQUIRED_CONF = {
    # Event times arrive as UTC instants; window boundaries and date parts are
    # computed in UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
}

# Settings that are good defaults at scale; applied only when unset.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only tables the planner has measured below 32 MB.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # What a task scans or sorts doesn't grow with the table beyond this.
    "spark.sql.files.maxPartitionBytes": str(32 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(32 * 1024 * 1024),
}


def build_session(master: str | None = None, app: str = "millrace",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Local/test session builder.  On a cluster, use the cluster's session and
    call :func:`ensure_session_defaults` instead."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if master and master.startswith("local"):
        # single JVM: the driver heap is the executor heap
        b = b.config("spark.driver.memory", os.environ.get("MILLRACE_DRIVER_MEM", "8g"))
    for k, v in {**REQUIRED_CONF, **SCALE_DEFAULTS}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_session_defaults(spark)
    return spark


def ensure_session_defaults(spark: SparkSession) -> SparkSession:
    """Apply REQUIRED_CONF always, SCALE_DEFAULTS only where unset."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    for k, v in SCALE_DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster must set it (a shared file system); where it does not, this
    raises.  Only with a local master, where driver and executors are one
    process, is a fresh scratch folder picked when it is unset.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir() if hasattr(
            spark.sparkContext, "getCheckpointDir") else None
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="millrace-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        spark.sparkContext.setCheckpointDir(d)
    except Exception:  # pragma: no cover - some deployments forbid it
        pass
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint dir for written intermediate
    tables (lineage cut that survives executor loss)."""
    return os.path.join(checkpoint_dir(spark), name)
