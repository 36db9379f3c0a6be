"""The quality gate: metrics of every episode in one plan over its frames, and the rules over the metric tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motionloom.functions.vectors import finite, minus, norm, scaled
from motionloom.operators.hand import hand_metrics
from motionloom.operators.rules import Rule, issues
from motionloom.operators.stats import robust_masks, summary
from motionloom.schema import SLICES

GROUPS = ("arm_joint", "eef_state", "hand_state", "eef_action", "hand_action")

# Codes and thresholds of the published quality standard.
HIGH_METRICS = {
    "action_step_l2_p95": "large_action_jump",
    "state_step_l2_p95": "large_state_jump",
    "arm_joint_jerk_l2_p95": "large_arm_joint_jerk",
    "eef_state_jerk_l2_p95": "large_eef_jerk",
    "hand_state_jerk_l2_p95": "large_hand_jerk",
    "finger_velocity_p95": "large_finger_velocity",
    "finger_acceleration_p95": "large_finger_acceleration",
}
SATURATION, TIME_OFFSET_S, JITTER_S = 0.10, 0.12, 0.015
LAG_LEAST, LAG_STD, LAG_FAR = 8, 4.0, 6.0
BLUR, DARK, BRIGHT, EXPOSURE = 20.0, 25.0, 230.0, 0.35
JUMP_MM, DOT, CLIP = 30.0, 0.05, 0.10


def episode_metrics(frames: DataFrame, fps: float, key: str = "episode_index", frame: str = "frame_index", groups: Sequence[str] = GROUPS) -> DataFrame:
    """Key, parquet_rows, finite_state, finite_action, widths, step and derivative statistics. One sort per episode: each
    order of derivative is a lag over the one before."""
    at = Window.partitionBy(key).orderBy(frame)
    ok = lambda v: F.forall(v, lambda x: finite(x).isNotNull())
    made = frames.select(key, frame, "state", "action")
    exprs: list[Column] = []
    for c in ("state", "action"):
        made = made.withColumn(f"{c}_step", norm(minus(F.col(c), F.lag(c).over(at))))
        exprs += [F.bool_and(ok(F.col(c))).alias(f"finite_{c}"), F.max(F.size(c)).alias(f"{c}_dim"), (F.min(F.size(c)) == F.max(F.size(c))).alias(f"{c}_even"), *summary(F.col(f"{c}_step"), f"{c}_step_l2")]
    for g in groups:
        made = made.withColumn(f"{g}_0", SLICES[g].of())
        for n, name in enumerate(("velocity", "acceleration", "jerk")):
            made = made.withColumn(f"{g}_{n + 1}", scaled(minus(F.col(f"{g}_{n}"), F.lag(f"{g}_{n}").over(at)), fps))
            exprs += summary(norm(F.col(f"{g}_{n + 1}")), f"{g}_{name}_l2")
    out = made.groupBy(key).agg(F.count(F.lit(1)).alias("parquet_rows"), *exprs)
    if "hand_state" not in groups:
        return out
    hand = hand_metrics(frames, SLICES["hand_state"].of(), fps, key, frame)
    return out.join(hand.withColumnRenamed(key, "__key"), F.col(key) == F.col("__key"), "left").drop("__key")


def _false(name: str) -> Column:
    return ~F.coalesce(F.col(name), F.lit(True))


def _over(name: str, limit: float) -> Column:
    return F.coalesce(finite(F.col(name).cast("double")) > limit, F.lit(False))


def episode_issues(episodes: DataFrame) -> DataFrame:
    """Errors of structure, and lengths and motions that stand out among all episodes. Columns that are absent have no rule."""
    have = set(episodes.columns)
    flags = [("parquet_rows", False, "__short"), ("parquet_rows", True, "__long"), *[(m, True, f"__{m}") for m in HIGH_METRICS if m in have]]
    t = robust_masks(episodes, [f for f in flags if f[0] in have])
    rules = [Rule("episode_error", "error", F.col("status") != "ok")] if "status" in have else []
    for column, code in (("frame_count_match", "state_action_frame_mismatch"), ("video_frame_count_match", "video_frame_mismatch"), ("finite_state", "nonfinite_state"), ("finite_action", "nonfinite_action")):
        if column in have:
            rules.append(Rule(code, "error", _false(column), column))
    if "parquet_rows" in have:
        rules += [Rule("short_episode_outlier", "warning", F.col("__short"), "parquet_rows", F.col("parquet_rows")), Rule("long_episode_outlier", "warning", F.col("__long"), "parquet_rows", F.col("parquet_rows"))]
    rules += [Rule(code, "warning", F.col(f"__{m}"), m, F.col(m)) for m, code in HIGH_METRICS.items() if m in have]
    if "saturation_ratio" in have:
        rules.append(Rule("hand_saturation", "warning", _over("saturation_ratio", SATURATION), "saturation_ratio", F.col("saturation_ratio")))
    return issues(t, rules)


def timing_issues(timing: DataFrame) -> DataFrame:
    """Offsets and jitter beyond their limits; lags far from the median where lags scatter (sample deviation over 4, 8 or more)."""
    lag = finite(F.col("action_state_lag").cast("double"))
    one = timing.agg(F.count(lag).alias("__n"), F.stddev_samp(lag).alias("__sd"), F.percentile(lag, F.lit(0.5)).alias("__med"))
    far = (F.col("__n") >= LAG_LEAST) & (F.col("__sd") > LAG_STD) & (F.abs(lag - F.col("__med")) > LAG_FAR)
    rules = [
        Rule("timing_unavailable", "warning", ~F.col("timing_status").isin("ok", "skipped")),
        Rule("large_time_offset", "warning", _over("max_abs_time_offset", TIME_OFFSET_S), "max_abs_time_offset", F.col("max_abs_time_offset")),
        Rule("camera_jitter", "warning", _over("camera_frame_jitter", JITTER_S), "camera_frame_jitter", F.col("camera_frame_jitter")),
        Rule("unstable_action_state_lag", "warning", F.coalesce(far, F.lit(False)), "action_state_lag", F.col("action_state_lag")),
    ]
    return issues(timing.join(F.broadcast(one)), rules)


def video_issues(videos: DataFrame) -> DataFrame:
    """Absolute limits first; what is within them may still stand out among all videos."""
    t = robust_masks(videos, [("blur_score", False, "__blur"), ("brightness_mean", False, "__dark"), ("brightness_mean", True, "__bright"), ("optical_flow_magnitude", True, "__flow")])
    low_blur = F.coalesce(finite(F.col("blur_score")) < BLUR, F.lit(False))
    light = finite(F.col("brightness_mean"))
    bad_light = F.coalesce((light < DARK) | (light > BRIGHT), F.lit(False))
    value = lambda m: (m, F.col(m))
    rules = [
        Rule("video_error", "error", ~F.col("video_status").isin("ok", "skipped"), "video_status"),
        Rule("low_blur_score", "warning", low_blur, *value("blur_score")),
        Rule("relative_low_blur", "warning", ~low_blur & F.col("__blur"), *value("blur_score")),
        Rule("bad_brightness", "warning", bad_light, *value("brightness_mean")),
        Rule("relative_dark_video", "warning", ~bad_light & F.col("__dark"), *value("brightness_mean")),
        Rule("relative_bright_video", "warning", ~bad_light & ~F.col("__dark") & F.col("__bright"), *value("brightness_mean")),
        Rule("relative_high_optical_flow", "warning", F.col("__flow"), *value("optical_flow_magnitude")),
        Rule("overexposed_video", "warning", _over("overexposure_ratio", EXPOSURE), *value("overexposure_ratio")),
        Rule("underexposed_video", "warning", _over("underexposure_ratio", EXPOSURE), *value("underexposure_ratio")),
    ]
    return issues(t, rules)


def structure_issues(declared: DataFrame, frames: DataFrame, fps: float, tolerance_s: float = 0.25, least: int = 1, state_dim: int = 26, action_dim: int = 19) -> DataFrame:
    """declared: episode_index, source_date, length. Frames need index order in frame_index, timestamp, done, state, action."""
    key, at = "episode_index", Window.partitionBy("episode_index").orderBy("row_no")
    ts = F.col("timestamp")
    rows = frames.withColumns({"__dt": ts - F.lag(ts).over(at), "__i": F.row_number().over(at) - 1, "__last": F.lead("row_no").over(at).isNull()})
    bad = lambda c: F.sum(F.size(F.filter(c, lambda x: finite(x).isNull())))
    got = rows.groupBy(F.col(key).alias("__e")).agg(
        F.count(F.lit(1)).alias("rows"), bad(F.col("state")).alias("bad_state"), bad(F.col("action")).alias("bad_action"),
        F.count_if(F.size("state") != state_dim).alias("wide_state"), F.count_if(F.size("action") != action_dim).alias("wide_action"),
        F.count_if(finite(ts).isNull()).alias("bad_ts"), F.count_if(F.col("__dt") < -1e-6).alias("back"), F.count_if(F.abs(F.col("__dt") - 1 / fps) > tolerance_s).alias("gaps"),
        F.bool_and(F.col("frame_index") == F.col("__i")).alias("in_order"), F.bool_and(F.col("done").eqNullSafe(F.col("__last"))).alias("done_ok"),
    )
    t = declared.join(got, F.col(key) == F.col("__e"), "left")
    there = F.col("rows").isNotNull()
    count = lambda code, column, severity="error": Rule(code, severity, there & (F.col(column) > 0), column, F.col(column))
    rules = [
        Rule("short_episode", "error", F.col("length") < least, "length", F.col("length")),
        Rule("missing_parquet", "error", ~there),
        Rule("length_mismatch", "error", there & (F.col("rows") != F.col("length")), "rows", F.col("rows")),
        count("state_width_mismatch", "wide_state"), count("action_width_mismatch", "wide_action"), count("nonfinite_state", "bad_state"), count("nonfinite_action", "bad_action"),
        count("nonfinite_timestamp", "bad_ts"), count("timestamp_not_monotonic", "back"), count("timestamp_gap", "gaps", "warning"),
        Rule("frame_index_not_contiguous", "warning", there & ~F.col("in_order")), Rule("done_column_unexpected", "warning", there & ~F.col("done_ok")),
    ]
    return issues(t, rules)


def motion_issues(metrics: DataFrame) -> DataFrame:
    """Rules of the report over all dates, on a row per episode."""
    limits = (("action_step_xyz_l2_mm_max", "large_action_xyz_jump", JUMP_MM), ("state_step_xyz_l2_mm_max", "large_state_xyz_jump", JUMP_MM), ("action_rot6d_col01_abs_dot_p99", "action_rot6d_not_orthogonal", DOT), ("relative_h32_q01q99_clip_ratio", "high_h32_clip_ratio", CLIP))
    return issues(metrics, [Rule(code, "warning", _over(m, limit), m, F.col(m)) for m, code, limit in limits if m in metrics.columns])
