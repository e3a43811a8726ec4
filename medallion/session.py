"""Session construction and the shared working folder.

The working folder for checkpoints, landing copies and written tables is taken from the cluster's
``spark.checkpoint.dir`` setting.  Only when the session has none (a bare local test run) is a private folder
created and registered, so that jobs never depend on a machine-local path on a cluster.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this library relies on.  UTC pins timestamp semantics so results equal other
# engines'; AQE re-plans joins and partition counts at runtime and splits skewed sort-merge join partitions.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(
    app: str = "medallion",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Return a session configured for this library (creates one when none is active)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in CORE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable core settings to an existing session (idempotent)."""
    for k, v in CORE_CONF.items():
        if spark.conf.isModifiable(k):  # static settings stay as the cluster set them
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the session (``spark.checkpoint.dir``); registered if only a conf value."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if root:
        if not current:
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    if current:
        return current.rstrip("/")
    # Unset: a private folder, registered on the session for later calls - where driver and executors are one process.
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = tempfile.mkdtemp(prefix="medallion-")
    spark.conf.set("spark.checkpoint.dir", root)
    sc.setCheckpointDir(root)
    return root


def work_dir(spark: SparkSession, name: str, fresh: bool = True) -> str:
    """A sub-folder of the shared checkpoint folder; ``fresh`` makes it unique for this run."""
    base = checkpoint_root(spark)
    leaf = f"{name}-{uuid.uuid4().hex[:12]}" if fresh else name
    return f"{base}/medallion/{leaf}"

