"""Queries on what an export joins and reads: frames by their place in a file, numbers of mixed lists, embeddings with dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionloom.functions import text as X
from motionloom.functions.vectors import norm, r6
from motionloom.operators import cameras, embeddings
from motionloom.operators import sequences as Q
from motionloom.plans.registry import query
from motionloom.plans.views import read, seconds

E = "episode_index"


@query("video_ordinal_lookup", """WITH r AS (SELECT event_type AS camera, user_id AS file, CAST(floor(epoch(ts) / 60) AS BIGINT) AS frame, event_id FROM events),
 f AS (SELECT camera, file, frame, min(event_id) AS r FROM r GROUP BY 1, 2, 3), o AS (SELECT camera, file, frame, row_number() OVER (PARTITION BY camera, file ORDER BY r, frame) - 1 AS ordinal FROM f),
 s AS (SELECT event_id, camera, file, CASE WHEN event_id % 11 <> 0 THEN frame + event_id % 3 // 2 END AS frame FROM r)
 SELECT s.event_id, s.camera, o.ordinal, CASE WHEN o.ordinal IS NULL THEN 'missing_video' END AS video_reason FROM s LEFT JOIN o ON s.camera = o.camera AND s.file = o.file AND s.frame = o.frame""")
def video_ordinal_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Every event is a step that names a frame of its camera's file; a third names the next one, which may be absent, and a few none."""
    r = read(spark, d, "events").select(F.col("event_type").alias("camera"), F.col("user_id").alias("file"), F.floor(seconds("ts") / 60).cast("bigint").alias("frame"), "event_id")
    named = F.when(F.col("event_id") % 11 != 0, F.col("frame") + F.floor(F.col("event_id") % 3 / 2))
    steps = r.select("event_id", "camera", "file", named.alias("frame"))
    out = cameras.with_ordinals(steps, Q.video_ordinals(r, "camera", "file", "frame", "event_id"), "camera", "file", "frame")
    return out.select("event_id", "camera", "ordinal", "video_reason")


@query("numeric_items", """WITH x AS (SELECT o_orderkey, '[' || o_custkey || ', "' || o_orderstatus || '", ' || CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'null' END || ', [1], ' || (o_custkey % 7) || '.5]' AS t FROM orders)
 SELECT o_orderkey, CAST(list_sum(v) AS DOUBLE) AS total, CAST(len(v) AS BIGINT) AS kept FROM (SELECT o_orderkey, list_transform(list_filter(from_json(t, '["json"]'), lambda j: json_type(j) IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'BOOLEAN')), lambda j: CASE WHEN json_type(j) = 'BOOLEAN' THEN CASE WHEN CAST(j AS VARCHAR) = 'true' THEN 1 ELSE 0 END ELSE CAST(j AS DOUBLE) END) AS v FROM x)""")
def numeric_items(spark: SparkSession, d: str) -> DataFrame:
    """Of a mixed list per order, the numbers."""
    o = read(spark, d, "orders")
    t = F.concat(F.lit("["), F.col("o_custkey").cast("string"), F.lit(', "'), F.col("o_orderstatus"), F.lit('", '), F.when(F.col("o_orderkey") % 2 == 0, "true").otherwise("null"), F.lit(", [1], "), (F.col("o_custkey") % 7).cast("string"), F.lit(".5]"))
    v = o.select("o_orderkey", X.numeric_items(F.parse_json(t)).alias("v"))
    return v.select("o_orderkey", F.aggregate("v", F.lit(0.0), lambda s, x: s + x).alias("total"), F.size("v").cast("bigint").alias("kept"))


@query("embedding_dates", """WITH e AS (SELECT vec_id AS episode_index, CASE WHEN vec_id % 7 = 3 THEN CAST(embedding[1:8] AS DOUBLE[]) WHEN vec_id % 7 <> 5 THEN CAST(embedding AS DOUBLE[]) END AS v FROM embeddings),
 w AS (SELECT len(v) AS width FROM e WHERE len(v) > 0 ORDER BY episode_index LIMIT 1), p AS (SELECT o_custkey AS k, strftime(min(o_orderdate), '%Y-%m') AS source_date FROM orders GROUP BY 1)
 SELECT e.episode_index, CAST(len(v) AS BIGINT) AS width, round(sqrt(list_sum(list_transform(v, lambda x: x * x))), 6) AS length, p.source_date FROM e JOIN w ON len(v) = width LEFT JOIN p ON e.episode_index = p.k""")
def embedding_dates(spark: SparkSession, d: str) -> DataFrame:
    """Embeddings as JSON, some of another width and some absent; those of the first one's width with the date of their episode."""
    v = F.col("embedding").cast("array<double>")
    text = F.when(F.col("vec_id") % 7 == 3, F.to_json(F.slice(v, 1, 8))).when(F.col("vec_id") % 7 != 5, F.to_json(v))
    e = read(spark, d, "embeddings").select(F.col("vec_id").alias(E), text.alias("video_embedding"))
    p = read(spark, d, "orders").groupBy(F.col("o_custkey").alias(E)).agg(F.date_format(F.min("o_orderdate"), "yyyy-MM").alias("source_date"))
    out = embeddings.with_dates(embeddings.vectors(e, "video_embedding"), p)
    return out.select(E, F.size("v").cast("bigint").alias("width"), r6(norm(F.col("v"))).alias("length"), "source_date")
