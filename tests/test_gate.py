"""The quality gate on hand-made episodes."""

from pyspark.sql import functions as F

from motionloom.operators import gate


def frames(spark, bad=False):
    rows = []
    for e in range(3):
        for t in range(12):
            state, action = [t * 0.1] * 26, [t * 0.2] * 19
            if bad and e == 1 and t == 4:
                state[0] = float("nan")
            rows.append((e, t, t, t / 10 if not (bad and e == 2 and t == 6) else 0.0, t == 11 or (bad and e == 2 and t == 3), state, action))
    return spark.createDataFrame(rows, "episode_index bigint, row_no bigint, frame_index bigint, timestamp double, done boolean, state array<double>, action array<double>")


def test_metrics_of_constant_motion(spark):
    r = gate.episode_metrics(frames(spark), 10).orderBy("episode_index").first()
    assert r.parquet_rows == 12 and r.finite_state and r.state_dim == 26 and r.action_dim == 19
    assert abs(r.state_step_l2_p95 - 0.1 * 26**0.5) < 1e-9 and abs(r.arm_joint_velocity_l2_mean - 7**0.5) < 1e-9 and r.hand_state_jerk_l2_max < 1e-9


def test_structure(spark):
    declared = spark.createDataFrame([(e, "d", 12) for e in range(4)], "episode_index bigint, source_date string, length bigint")
    assert {(r.episode_index, r.code) for r in gate.structure_issues(declared, frames(spark), 10).collect()} == {(3, "missing_parquet")}
    found = {(r.episode_index, r.code) for r in gate.structure_issues(declared, frames(spark, bad=True), 10).collect()}
    assert found == {(3, "missing_parquet"), (1, "nonfinite_state"), (2, "timestamp_not_monotonic"), (2, "timestamp_gap"), (2, "done_column_unexpected")}


def test_episode_rules(spark):
    rows = [(i, "d", "ok", 100 + i % 3, True, 1.0 + 0.01 * (i % 4), 0.0) for i in range(9)] + [(9, "d", "error", 900, False, 50.0, 0.5)]
    t = spark.createDataFrame(rows, "episode_index bigint, source_date string, status string, parquet_rows bigint, finite_state boolean, action_step_l2_p95 double, saturation_ratio double")
    assert sorted((r.episode_index, r.code) for r in gate.episode_issues(t).collect()) == [(9, c) for c in ("episode_error", "hand_saturation", "large_action_jump", "long_episode_outlier", "nonfinite_state")]


def test_timing_and_video_rules(spark):
    t = spark.createDataFrame([(i, "d", "ok", 0.01, 0.001, float(20 * (i == 8))) for i in range(9)] + [(9, "d", "missing", 0.5, 0.1, None)], "episode_index bigint, source_date string, timing_status string, max_abs_time_offset double, camera_frame_jitter double, action_state_lag double")
    assert sorted((r.episode_index, r.code) for r in gate.timing_issues(t).collect()) == [(8, "unstable_action_state_lag"), (9, "camera_jitter"), (9, "large_time_offset"), (9, "timing_unavailable")]
    v = spark.createDataFrame([(i, "d", "ok", 100.0 + i % 3, 120.0 + i % 2, 1.0, 0.0, 0.0) for i in range(9)] + [(9, "d", "ok", 5.0, 240.0, None, 0.6, float("nan"))], "episode_index bigint, source_date string, video_status string, blur_score double, brightness_mean double, optical_flow_magnitude double, overexposure_ratio double, underexposure_ratio double")
    assert sorted(r.code for r in gate.video_issues(v).collect()) == ["bad_brightness", "low_blur_score", "overexposed_video"]
    m = spark.createDataFrame([(0, "d", 31.0, None)], "episode_index bigint, source_date string, action_step_xyz_l2_mm_max double, relative_h32_q01q99_clip_ratio double")
    assert [r.code for r in gate.motion_issues(m).collect()] == ["large_action_xyz_jump"]
