"""Queries on recorded streams: as-of matches, resampling, camera sync, ordinals, timing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from motionloom.functions.vectors import r6
from motionloom.operators import asof as S
from motionloom.operators import sequences as Q
from motionloom.plans.registry import query
from motionloom.plans.views import SFR, read, scalar_frames, seconds, stream, stream_sql

E = "episode_index"
CLICK, VIEW, BUY, ERR = stream_sql("clicks", "click"), stream_sql("views", "view"), stream_sql("buys", "purchase"), stream_sql("errs", "error")


def _match_sql(how: str, targets: str, records: str, out: str, ts: str = "ts") -> str:
    """Brute force: every record of the key for every target, the best by (|dt|, log order)."""
    best = f"row_number() OVER (PARTITION BY t.tid ORDER BY {'CASE WHEN r.ts - t.ts >= -1e-9 THEN 0 ELSE 1 END, ' if how == 'future' else ''}abs(r.ts - t.ts), r.record_no)"
    return f"{out} AS (SELECT tid, record_no, dt FROM (SELECT t.tid, r.record_no, r.ts - t.ts AS dt, {best} AS k FROM {targets} t JOIN {records} r USING (episode_index)) WHERE k = 1)"


TARGETS = "t AS (SELECT episode_index, ts, record_no AS tid FROM views)"


def _asof(spark: SparkSession, d: str, how: str) -> DataFrame:
    views = stream(spark, d, "view").withColumnRenamed("record_no", "tid")
    out = S.asof(views, stream(spark, d, "click"), E, "ts", "record_no", how)
    return out.select(E, F.col("tid").alias("event_id"), F.col("m_no").alias("match_id"), r6("m_dt").alias("dt"))


@query("asof_nearest", f"WITH {VIEW}, {CLICK}, {TARGETS}, {_match_sql('nearest', 't', 'clicks', 'm')} SELECT t.episode_index, t.tid AS event_id, m.record_no AS match_id, round(m.dt, 6) AS dt FROM t LEFT JOIN m USING (tid)")
def asof_nearest(spark: SparkSession, d: str) -> DataFrame:
    return _asof(spark, d, "nearest")


@query("asof_future_fallback", f"WITH {VIEW}, {CLICK}, {TARGETS}, {_match_sql('future', 't', 'clicks', 'm')} SELECT t.episode_index, t.tid AS event_id, m.record_no AS match_id, round(m.dt, 6) AS dt FROM t LEFT JOIN m USING (tid)")
def asof_future_fallback(spark: SparkSession, d: str) -> DataFrame:
    return _asof(spark, d, "future")


RATE, TOLERANCE = 1 / 7200, 7200.0
GRID = f"""b AS (SELECT c.episode_index, greatest(min(c.ts), max(v.lo), max(p.lo)) AS lo, least(max(c.ts), max(v.hi), max(p.hi)) AS hi FROM clicks c
 JOIN (SELECT episode_index, min(ts) AS lo, max(ts) AS hi FROM views GROUP BY 1) v USING (episode_index) JOIN (SELECT episode_index, min(ts) AS lo, max(ts) AS hi FROM buys GROUP BY 1) p USING (episode_index) GROUP BY 1),
 g AS (SELECT episode_index, step, lo + step / {RATE!r}::DOUBLE AS ts, episode_index * 10000000 + step AS tid FROM (SELECT episode_index, lo, unnest(range(0, CAST(trunc((hi - lo) * {RATE!r}::DOUBLE) AS BIGINT) + 1)) AS step FROM b WHERE hi > lo))"""


@query("resample_align", f"""WITH {CLICK}, {VIEW}, {BUY}, {GRID}, {_match_sql('future', 'g', 'clicks', 'ma')}, {_match_sql('nearest', 'g', 'views', 'mr')}, {_match_sql('nearest', 'g', 'buys', 'mv')}
 SELECT g.episode_index, g.step, ma.record_no AS action_no, mr.record_no AS robot_no, mv.record_no AS video_no,
 CASE WHEN abs(ma.dt) > {TOLERANCE} THEN 'action_out_of_tolerance' WHEN abs(mr.dt) > {TOLERANCE} THEN 'robot_out_of_tolerance' WHEN abs(mv.dt) > {TOLERANCE} THEN 'video_out_of_tolerance' ELSE 'ok' END AS reason
 FROM g LEFT JOIN ma USING (tid) LEFT JOIN mr USING (tid) LEFT JOIN mv USING (tid)""")
def resample_align(spark: SparkSession, d: str) -> DataFrame:
    """A step every two hours; clicks are actions (forward), views robot states and purchases video (nearest)."""
    c, v, p = (stream(spark, d, k) for k in ("click", "view", "purchase"))
    grid = S.grid([c, v, p], E, "ts", RATE)
    out = S.align(grid, {"action": (c, "future"), "robot": (v, "nearest"), "video": (p, "nearest")}, E, "ts", "record_no", TOLERANCE)
    return out.select(E, "step", "action_no", "robot_no", "video_no", "reason")


@query("multi_camera_sync", f"""WITH {VIEW}, {CLICK}, {ERR}, {TARGETS}, {_match_sql('nearest', 't', 'clicks', 'a')}, {_match_sql('nearest', 't', 'errs', 'b')}
 SELECT t.episode_index, t.tid AS event_id, a.record_no AS left_no, b.record_no AS right_no, round((t.ts + (t.ts + a.dt) + (t.ts + b.dt)) / 3, 4) AS mean_ts FROM t JOIN a USING (tid) JOIN b USING (tid)""")
def multi_camera_sync(spark: SparkSession, d: str) -> DataFrame:
    views = stream(spark, d, "view").withColumnRenamed("record_no", "tid")
    out = S.camera_sync(views, {"left": stream(spark, d, "click"), "right": stream(spark, d, "error")}, E, "ts", "record_no")
    return out.select(E, F.col("tid").alias("event_id"), "left_no", "right_no", F.round("mean_ts", 4).alias("mean_ts"))


@query("video_ordinals", """WITH f AS (SELECT event_type AS camera, user_id AS file, CAST(floor(epoch(ts) / 60) AS BIGINT) AS frame, min(event_id) AS r FROM events GROUP BY 1, 2, 3)
 SELECT camera, file, frame, row_number() OVER (PARTITION BY camera, file ORDER BY r, frame) - 1 AS ordinal FROM f""")
def video_ordinals(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").select(F.col("event_type").alias("camera"), F.col("user_id").alias("file"), F.floor(seconds("ts") / 60).cast("bigint").alias("frame"), "event_id")
    return Q.video_ordinals(e, "camera", "file", "frame", "event_id")


@query("timestamp_gaps", f"""WITH {SFR}, x AS (SELECT episode_index, ts - lag(ts) OVER (PARTITION BY episode_index ORDER BY event_id) AS dt FROM sfr)
 SELECT episode_index, CAST(count_if(dt < -1e-6) AS BIGINT) AS backwards, CAST(count_if(abs(dt - 3600) > 1800) AS BIGINT) AS gaps, round(max(abs(dt - 3600)), 4) AS worst FROM x GROUP BY 1""")
def timestamp_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Steps in log order against a nominal hour: backward steps, steps out of tolerance, the largest deviation."""
    dt = F.col("ts") - F.lag("ts").over(Window.partitionBy(E).orderBy("event_id"))
    s = scalar_frames(spark, d).select(E, dt.alias("dt"))
    return s.groupBy(E).agg(F.count_if(F.col("dt") < -1e-6).alias("backwards"), F.count_if(F.abs(F.col("dt") - 3600) > 1800).alias("gaps"), F.round(F.max(F.abs(F.col("dt") - 3600)), 4).alias("worst"))


@query("timing_offset_jitter", f"""WITH {SFR}, d AS (SELECT episode_index, event_type, ts - lag(ts) OVER (PARTITION BY episode_index, event_type ORDER BY ts, event_id) AS dt, count(*) OVER (PARTITION BY episode_index, event_type) AS n FROM sfr),
 m AS (SELECT episode_index, event_type, median(dt) AS med FROM d WHERE n >= 3 GROUP BY 1, 2)
 SELECT episode_index, round(avg(abs(dt - med)), 4) AS jitter, count(dt) AS steps FROM d JOIN m USING (episode_index, event_type) GROUP BY 1""")
def timing_offset_jitter(spark: SparkSession, d: str) -> DataFrame:
    """Per episode, pooled over cameras (event types) with three records or more: mean distance of a step from its camera's median."""
    s = scalar_frames(spark, d)
    cam = Window.partitionBy(E, "event_type")
    dt = s.select(E, "event_type", (F.col("ts") - F.lag("ts").over(cam.orderBy("ts", "event_id"))).alias("dt"), F.count(F.lit(1)).over(cam).alias("n"))
    med = dt.where("n >= 3").withColumn("med", F.percentile("dt", F.lit(0.5)).over(cam))
    return med.groupBy(E).agg(F.round(F.avg(F.abs(F.col("dt") - F.col("med"))), 4).alias("jitter"), F.count("dt").alias("steps"))
