"""Session settings the jobs are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE re-plans joins by measured size and splits skewed join partitions.  The
# co-partition setting lets a join on (member, source, org, month) reuse a
# shuffle that is already on (member, month) instead of repeating it; where the
# first of two such joins turns out skewed, the forced split takes precedence
# over the reuse.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """Create a session with SETTINGS; ``extra`` wins, dots written as ``__``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
