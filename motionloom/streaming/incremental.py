"""Streaming forms: an append-only log processed once per file, and windows with late data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def process_new(spark: SparkSession, path: str, schema: str, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> None:
    """Hands the files under path that no earlier call has seen to handle, exactly once, and ends."""
    q = spark.readStream.schema(schema).parquet(path).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def windowed_counts(events: DataFrame, ts: str = "ts", key: str = "event_type", width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """key, window start, events, mean of value; rows later than the watermark are dropped by the engine."""
    w = events.withWatermark(ts, late).groupBy(F.window(ts, width), key)
    return w.agg(F.count(F.lit(1)).alias("events"), F.avg("value").alias("mean")).select(key, F.col("window.start").alias("start"), "events", "mean")


def align_streams(left: DataFrame, right: DataFrame, key: str, ts: str, tolerance: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Pairs of two live streams within a tolerance: an interval join, whose state is bounded by the watermarks."""
    a = left.withWatermark(ts, late).select(F.col(key).alias(key), F.col(ts).alias("left_ts"), F.col("record_no").alias("left_no"))
    b = right.withWatermark(ts, late).select(F.col(key).alias("__k"), F.col(ts).alias("right_ts"), F.col("record_no").alias("right_no"))
    near = (F.col(key) == F.col("__k")) & (F.col("right_ts") >= F.col("left_ts") - F.expr(f"INTERVAL {tolerance}")) & (F.col("right_ts") <= F.col("left_ts") + F.expr(f"INTERVAL {tolerance}"))
    return a.join(b, near).drop("__k")
