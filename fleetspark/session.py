"""Spark session helpers for tests, the bench and local runs.

Library functions never create sessions; they take DataFrames.  These helpers
only fill in settings that are *unset*, so a cluster's own configuration
(checkpoint folder, shuffle partitions, time zone) always wins.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", app: str = "fleetspark", **conf: str) -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in {**LOCAL_DEFAULTS, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; create a scratch one only for a local session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is; without it there is no folder that driver and executors share, which is
    an error.  A local session (one process) gets a fresh folder under /tmp.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="fleetspark-ckpt-", dir=os.environ.get("FLEETSPARK_SCRATCH", "/tmp"))
    spark.sparkContext.setCheckpointDir(path)
    try:
        spark.conf.set("spark.checkpoint.dir", path)
    except Exception:  # noqa: BLE001  (some deployments reject core settings at runtime)
        pass
    return path
