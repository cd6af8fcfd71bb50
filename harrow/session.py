"""Session helpers: one place that builds a session and finds shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for every job in the library.  Shuffle partitions are sized
# for local runs here; on a cluster the caller's session settings win.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "harrow") -> SparkSession:
    """Build (or reuse) a session with the library defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("HARROW_DRIVER_MEMORY", "8g"))
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    A machine-local folder is made only for ``local`` masters (tests, laptops): on a
    cluster other executors could not read it, so there the setting is required.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local[") or sc.master == "local":
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="harrow-ckpt-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return sc.getCheckpointDir()


def freeze(df: DataFrame) -> DataFrame:
    """Cut lineage into the shared checkpoint folder (never a local checkpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/harrow-{name}-{uuid.uuid4().hex[:12]}"
