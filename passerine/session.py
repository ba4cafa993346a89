"""Session settings the engine relies on, kept in one place."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that change results or plans; all of them can be set at run time.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Splitting a hot partition is worth a further shuffle downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # HotSpot never compiles a method of more than 8000 bytes, and rows of payload maps need more: a stage over the limit
    # runs operator by operator instead, in methods short enough.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


# Settings that must be there when the session is created: no call-site capture per column expression,
# which otherwise dominates the time to build plans of many expressions.
STATIC_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the engine's run-time settings to a session the caller owns.

    Shuffle partitions, memory and the broadcast threshold stay the caller's.
    """
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def get_session(app: str = "passerine", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's settings; on a cluster ``master`` comes from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**STATIC_SETTINGS, **RUNTIME_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """Shared folder for cutting lineage: the cluster's own setting, else the caller's fallback."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if fallback:
        os.makedirs(fallback, exist_ok=True)
        spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it; a local session without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="passerine-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")
