"""Sessions with the settings that the operators expect."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def session(name: str = "motionloom", **settings: str) -> SparkSession:
    return SparkSession.builder.appName(name).config(map=SETTINGS | settings).getOrCreate()
