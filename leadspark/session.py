"""A session with the settings that the engine expects; a cluster's own settings win."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def session(master: str | None = None, **more: str) -> SparkSession:
    b = SparkSession.builder.appName("leadspark")
    if master:
        b = b.master(master)
    for k, v in {**SETTINGS, **{k.replace("__", "."): v for k, v in more.items()}}.items():
        b = b.config(k, v)
    return b.getOrCreate()
