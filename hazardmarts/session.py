"""Session settings the marts rely on, and the shared folder for cut lineage."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution sizes the post-shuffle partitions from real map output, splits skewed
# ones and re-plans joins, so no partition count is tied to one data size. UTC keeps text
# renderings of instants the same on every driver.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Do not record a Python stack trace for every column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` uses ``__`` for the dots of a key."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); ``fallback`` only where unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if fallback is None:
        raise ValueError("spark.checkpoint.dir is not set; name a shared folder")
    return fallback
