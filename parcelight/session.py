"""Session settings this library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Run-time re-planning: merge small shuffle partitions, split skewed ones,
    # turn a sort-merge join into a broadcast join when a side proves small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Recording the Python line behind every column costs more than planning.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    name: str = "parcelight", master: str | None = None, **settings: str
) -> SparkSession:
    """Session with :data:`SETTINGS`; sizes (memory, cores, shuffle
    partitions, ``spark.checkpoint.dir``) come from the cluster or
    ``settings``."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
