"""A session with the settings that the library expects, for scripts and tests."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "sentryloom", **conf: str) -> SparkSession:
    """UTC clock and adaptive execution; everything else is the caller's or the cluster's."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
