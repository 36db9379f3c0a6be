"""The driver's tables seen as episodes: vectors, scalars, streams and metadata; each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FPS = 10.0


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vector_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """episode_index, frame_index, state (26), action (19)."""
    e = read(spark, sf_dir, "embeddings")
    v = F.col("embedding").cast("array<double>")
    at = Window.partitionBy("label").orderBy("vec_id")
    return e.select(F.col("label").cast("bigint").alias("episode_index"), (F.row_number().over(at) - 1).cast("bigint").alias("frame_index"), F.slice(v, 1, 26).alias("state"), F.slice(v, 27, 19).alias("action"))


VF = """vf AS (SELECT CAST(label AS BIGINT) AS episode_index, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame_index,
 CAST(embedding[1:26] AS DOUBLE[]) AS state, CAST(embedding[27:45] AS DOUBLE[]) AS action FROM embeddings)"""


def seconds(ts: str):
    return F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(1e6)


def scalar_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """episode_index (user), frame_index, event_id, event_type, ts (seconds), value."""
    e = read(spark, sf_dir, "events").select(F.col("user_id").alias("episode_index"), "event_id", "event_type", seconds("ts").alias("ts"), "value")
    at = Window.partitionBy("episode_index").orderBy("ts", "event_id")
    return e.withColumn("frame_index", (F.row_number().over(at) - 1).cast("bigint"))


SFR = """sfr AS (SELECT user_id AS episode_index, event_id, event_type, epoch(ts) AS ts, value,
 row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame_index FROM events)"""


def stream(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """episode_index, ts, record_no of one event type."""
    e = read(spark, sf_dir, "events").where(F.col("event_type") == kind)
    return e.select(F.col("user_id").alias("episode_index"), seconds("ts").alias("ts"), F.col("event_id").alias("record_no"))


def stream_sql(name: str, kind: str) -> str:
    return f"{name} AS (SELECT user_id AS episode_index, epoch(ts) AS ts, event_id AS record_no FROM events WHERE event_type = '{kind}')"


def step_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer as an episode: n, mean, p95, max of order prices, and a source date."""
    o = read(spark, sf_dir, "orders")
    return o.groupBy(F.col("o_custkey").alias("episode_index")).agg(F.count(F.lit(1)).alias("frames"), F.round(F.avg("o_totalprice"), 6).alias("mean_price"), F.round(F.max("o_totalprice"), 6).alias("max_price"), F.date_format(F.min("o_orderdate"), "yyyy-MM").alias("source_date"))


EPISODES = """ep AS (SELECT o_custkey AS episode_index, count(*) AS frames, round(avg(o_totalprice), 6) AS mean_price, round(max(o_totalprice), 6) AS max_price,
 strftime(min(o_orderdate), '%Y-%m') AS source_date FROM orders GROUP BY o_custkey)"""
