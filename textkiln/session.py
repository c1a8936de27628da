"""Spark session with the settings that the operators expect."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoints go when nothing refers to them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def session(master: str | None = None, shuffle_partitions: int | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName("textkiln")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (SETTINGS | settings).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
