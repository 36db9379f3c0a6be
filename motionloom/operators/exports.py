"""From capture streams to frames: resampling, alignment, assembly, and the reasons why steps or episodes are left out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from motionloom.functions.payloads import action_vector, first_reason, state_vector
from motionloom.operators.asof import align, grid


@dataclass(frozen=True)
class Export:
    fps: float = 10.0
    tolerance_s: float = 0.1
    success_only: bool = False
    action_source: str = "safe_action"
    hand_names: tuple[str, ...] = ()


def export_steps(actions: DataFrame, robot: DataFrame, video: DataFrame, how: Export, key: str = "episode_index") -> DataFrame:
    """Key, step, ts, state, action, reason (null: kept). Streams need key, monotonic_ts_s and record_no."""
    ts, no = "monotonic_ts_s", "record_no"
    a, r, v = (s.where(F.col(ts).isNotNull()) for s in (actions.where(F.col(how.action_source).isNotNull()), robot, video))
    at = align(grid([a, r, v], key, ts, how.fps), {"action": (a, "future"), "robot": (r, "nearest"), "video": (v, "nearest")}, key, ts, no, how.tolerance_s)
    acts = a.select(F.col(key).alias("ak"), F.col(no).alias("an"), action_vector(F.col(how.action_source), how.hand_names).alias("action"))
    body = F.struct("arm_joint_positions", "hand_joint_positions", "arm_ee_pose")
    robs = r.select(F.col(key).alias("rk"), F.col(no).alias("rn"), state_vector(body).alias("state"))
    joined = at.join(acts, (F.col(key) == F.col("ak")) & (F.col("action_no") == F.col("an")), "left").join(robs, (F.col(key) == F.col("rk")) & (F.col("robot_no") == F.col("rn")), "left")
    why = F.when(F.col("reason") != "ok", F.col("reason")).otherwise(first_reason([("missing_action", F.col("action").isNotNull()), ("missing_robot_state", F.col("state").isNotNull())]))
    return joined.select(key, "step", F.col(ts).alias("ts"), "state", "action", F.col("video_no"), why.alias("reason"))


def frames_of(steps: DataFrame, fps: float, key: str = "episode_index") -> DataFrame:
    """Kept steps as frames: contiguous frame_index, the grid's step beside it, timestamp from the first frame, done on the last."""
    w = Window.partitionBy(key).orderBy("step")
    kept = steps.where("reason IS NULL")
    return kept.select(key, (F.row_number().over(w) - 1).cast("bigint").alias("frame_index"), "step", (F.col("ts") - F.first("ts").over(w)).alias("timestamp"), "state", "action", F.lead("step").over(w).isNull().alias("done"), F.lit(0.0).alias("reward"))


def skipped(episodes: DataFrame, steps: DataFrame, how: Export, key: str = "episode_index") -> DataFrame:
    """Key, reason of episodes that give no frames."""
    own = steps.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("reason").isNull()).alias("good"))
    joined = episodes.join(own, F.col(key) == F.col("k"), "left")
    reason = F.when(F.lit(how.success_only) & ~F.col("success").eqNullSafe(True), "filtered_non_success").when(F.col("n").isNull(), "empty_stream_time_intersection").when(F.col("good") == 0, "filtered_all_steps")
    return joined.select(key, reason.alias("reason")).where("reason IS NOT NULL")


def schema_breaks(frames: DataFrame, columns: Sequence[str] = ("state", "action"), key: str = "episode_index") -> DataFrame:
    """Episodes whose vectors change width, or have another width than most: key, column, least, most."""
    out = None
    for c in columns:
        own = frames.groupBy(key).agg(F.min(F.size(c)).alias("least"), F.max(F.size(c)).alias("most"))
        usual = own.agg(F.mode("most", True).alias("usual"))
        bad = own.join(F.broadcast(usual)).where("least <> most OR most <> usual").select(key, F.lit(c).alias("column"), "least", "most")
        out = bad if out is None else out.unionByName(bad)
    return out
