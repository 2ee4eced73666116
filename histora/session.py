"""A session with the settings the operators count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Runtime re-planning: joins turn to broadcast by measured size, hot keys are split, small partitions merged
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Tables that are loaded at the same time share the cluster
    "spark.scheduler.mode": "FAIR",
    # The three parts of a merged batch are written side by side instead of sorted first
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # Recording the Python call site of every expression makes wide contracts slow to plan
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(name: str = "histora", **settings: str) -> SparkSession:
    """Create or get the session. Master, memory and partition counts are the cluster's to set."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
