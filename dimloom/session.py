"""Session settings the loads rely on.  An existing session is used as it is."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings that matter for the plans; all are ordinary Spark configuration.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split across tasks, even where that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A task that writes few partitions keeps their files open instead of sorting its rows.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # The runtime threshold decides on the measured shuffle size of a side.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
}


def build_session(app: str = "dimloom", master: str | None = None, **extra: str) -> SparkSession:
    """Get or create a session with ``SETTINGS``; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
