"""Inspection and repair of positions, hand metrics on broken values, labels and dates."""

import math

import pytest
from pyspark.sql import functions as F

from motionloom.functions import text as T
from motionloom.operators import repair as R
from motionloom.operators import rules
from motionloom.operators.hand import METRICS, hand_metrics


@pytest.fixture(scope="module")
def frames(spark):
    """Episode 1 has its actions in the raw frame, episode 2 in the state's own, episode 3 in neither."""
    rows = []
    for k in range(40):
        s = [math.sin(k), math.cos(2 * k), math.sin(3 * k + 1)]
        raw = [s[1], s[2], s[0]]
        rows += [(1, k, s, [*raw, 7.0]), (2, k, s, [*s, 7.0]), (3, k, s, [math.cos(5 * k * k), 2.0, -s[0], 7.0])]
    return spark.createDataFrame(rows, "episode_index bigint, frame_index bigint, s array<double>, a array<double>")


def test_inspection_gate_and_repair(frames):
    seen = {r.episode_index: r for r in R.inspect_positions(frames, "s", "a").collect()}
    assert seen[1].best_is_expected and seen[1].best_perm == "201" and seen[1].expected_rmse < 1e-9 < seen[1].direct_rmse
    assert seen[2].best_is_identity and seen[2].direct_rmse < 1e-9
    inspected = R.inspect_positions(frames, "s", "a")
    assert sorted(r.episode_index for r in R.refused(inspected).collect()) == [2, 3]
    with pytest.raises(ValueError, match="2 episodes"):
        R.repair_positions(frames, inspected, "a")
    one = frames.where("episode_index = 1")
    fixed = R.repair_positions(one, R.inspect_positions(one, "s", "a"), "a")
    after = R.inspect_positions(fixed, "s", "a").first()
    assert after.best_is_identity and after.direct_rmse < 1e-9
    assert {len(r.a) for r in fixed.collect()} == {4} and {r.a[3] for r in fixed.collect()} == {7.0}


def test_diagnosis_summary_and_attachment(spark, frames):
    found = {r.episode_index: r for r in R.alignment_diagnosis(frames, "s", "a").collect()}
    assert found[1].suspected and not found[2].suspected and found[2].best_lag == 0
    inspected = R.inspect_positions(frames, "s", "a")
    total = R.mapping_summary(inspected.withColumn("d", F.lit("x")), "d").first()
    assert (total.episodes, round(total.expected_ratio, 6)) == (3, round(1 / 3, 6))
    tasks = spark.createDataFrame([(1, "a"), (2, "b")], "episode_index bigint, task string")
    assert R.attach_best(tasks, inspected, ["episode_index"]).count() == 2
    with pytest.raises(KeyError):
        R.attach_best(tasks.union(tasks.selectExpr("episode_index + 8", "task")), inspected, ["episode_index"])
    assert R.inspect_positions(frames.where("false"), "s", "a").count() == 0


def test_hand_metrics_skip_what_is_not_finite(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 0, [0.0, 1.0]), (1, 1, [nan, 0.99]), (1, 2, [0.5, inf]), (1, 3, [0.25, 0.0]), (2, 0, [0.5, 0.5]), (3, 0, [nan, nan])]
    df = spark.createDataFrame(rows, "episode_index bigint, frame_index bigint, h array<double>")
    got = {r.episode_index: r.asDict() for r in hand_metrics(df, F.col("h"), 10.0).collect()}
    assert set(got[1]) == {"episode_index", *METRICS}
    # finite: 0, 1, 0.99, 0.5, 0.25, 0
    assert got[1]["saturation_ratio"] == pytest.approx(2 / 6) and got[1]["zero_ratio"] == pytest.approx(2 / 6) and got[1]["finger_angle_max"] == 1.0
    assert got[2]["closing_duration"] == 0 and got[2]["finger_velocity_p95"] is None
    assert got[3]["finger_angle_mean"] is None and got[3]["zero_ratio"] is None
    assert hand_metrics(df.where("false"), F.col("h"), 10.0).count() == 0


def test_labels_dates_and_json_vectors(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    lit = F.lit
    assert one(T.output_label(lit("/a/sets_by_date/2024-01-02/pick/x"))) == "sets_by_date_2024-01-02_pick"
    assert one(T.output_label(lit("/a/b/sets_by_date"))) == "b_sets_by_date" and one(T.output_label(lit("alone"))) == "alone"
    assert tuple(one(T.routing(lit("/d/Nero/mission7/x")))) == ("nero", "mission7")
    assert tuple(one(T.routing(lit("/d/x"), lit("XMate3")))) == ("rokae", "mission_unspecified")
    assert one(T.shown_vector(F.array(lit(1.0), lit(-0.5)))) == "[1.0000, -0.5000] shape=(2,)"
    assert one(T.vector_of_json(lit("[1, 2.5]"), 2)) == [1.0, 2.5] and one(T.vector_of_json(lit("[1]"), 2)) is None and one(T.vector_of_json(lit("no"), 2)) is None
    assert one(T.action_name(lit(9))) == "thumb_cmc_pitch" and one(T.action_name(lit(40))) == "dim_40"
    dates = {"source": lit("2024-01-02"), "trimmed": lit(None).cast("string")}
    assert one(T.date_matches("2024-01-02", "any", dates)) and not one(T.date_matches("2024-01-02", "trimmed", dates))
    df = spark.createDataFrame([(k, float(k) if k % 3 else None) for k in range(30)], "episode_index bigint, m double")
    assert [r.episode_index for r in rules.top_by(df, "m").collect()] == [29, 28, 26, 25, 23, 22, 20, 19]


def test_frames_that_are_not_finite_are_left_out(spark, frames):
    nan, inf = float("nan"), float("inf")
    one = frames.where("episode_index = 1")
    odd = spark.createDataFrame([(1, 40, [nan, 0.0, 1.0], [0.0, 1.0, nan, 7.0]), (1, 41, [inf, 0.0, 1.0], [0.0, 1.0, 2.0, 7.0])], frames.schema)
    seen = R.inspect_positions(one.union(odd), "s", "a").first()
    assert seen.best_is_expected and seen.expected_rmse < 0.3 and seen.frames == 42 and seen.best_rmse < 1e-9
    assert R.alignment_diagnosis(one.union(odd), "s", "a").first().best_perm == "201"
    nothing = R.inspect_positions(odd.where("frame_index = 40").withColumn("s", F.array(*[F.lit(nan)] * 3)), "s", "a")
    assert nothing.first().expected_offset_rmse is None and R.refused(nothing).count() == 1
