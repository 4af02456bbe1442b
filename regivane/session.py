"""Spark session with the settings the library is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "regivane", master: str | None = None, **conf: str) -> SparkSession:
    """Adaptive execution on: it sizes partitions, splits skewed joins and picks broadcast joins by measured size."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.python.filterPushdown.enabled": "true",
    }
    for key, value in (defaults | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
