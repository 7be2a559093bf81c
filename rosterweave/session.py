"""A session with the settings this package is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def spark_session(app: str = "rosterweave", **conf: str) -> SparkSession:
    """Session with AQE (partition coalescing, skew-join splitting) and a pinned time zone.

    Generated methods above 8,000 bytes are never compiled by the JVM, so whole-stage code that
    grows beyond that is left to the operators one by one.
    The master, memory and shuffle width come from spark-submit or ``conf``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
