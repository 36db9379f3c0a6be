"""Conventions, maps and the gated repair of rotations."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from motionloom.functions.vectors import rot6d_rows
from motionloom.operators import rotation as R
from motionloom.operators.mapping import best_rotation_map, signed_axis_matrices

AXES = signed_axis_matrices()


def turn(rng):
    q = np.linalg.qr(np.array([[rng.gauss(0, 1) for _ in range(3)] for _ in range(3)]))[0]
    return q if np.linalg.det(q) > 0 else -q


def six(m, by_columns=False):
    return [float(x) for x in (np.concatenate([m[:, 0], m[:, 1]]) if by_columns else np.concatenate([m[0], m[1]]))]


@pytest.fixture(scope="module")
def frames(spark):
    """Episode 1: actions in their own frame, by columns. Episode 2: another map. Episode 3: none. One frame has a NaN."""
    rng, rows = random.Random(3), []
    left, right = AXES[R.NUMBERS[R.EXPECTED_LEFT]], AXES[R.NUMBERS[R.EXPECTED_RIGHT]]
    for k in range(30):
        s = turn(rng)
        made = {1: left.T @ s @ right.T, 2: AXES[7].T @ s @ AXES[0].T, 3: turn(rng)}
        for e, a in made.items():
            rows.append((e, k, [0.5, *six(s)], [1.0, *(six(a, True) if k or e != 1 else [float("nan")] * 6), 9.0]))
    return spark.createDataFrame(rows, "episode_index bigint, frame_index bigint, state array<double>, action array<double>")


def inspected(frames, **more):
    return R.inspect_rotations(frames.select("episode_index", "frame_index", F.slice("state", 2, 6).alias("s"), F.slice("action", 2, 6).alias("a")), "s", "a", **{"action_convention": "column_major", **more})


def test_every_name_is_its_matrix():
    assert len(R.NUMBERS) == 48 and (AXES[R.NUMBERS["+z,+x,+y"]] == [[0, 0, 1], [1, 0, 0], [0, 1, 0]]).all()
    assert (AXES[R.NUMBERS["-y,-z,+x"]] == [[0, -1, 0], [0, 0, -1], [1, 0, 0]]).all()


def test_maps_are_matrix_products(spark):
    rng = random.Random(1)
    m = turn(rng)
    rows = F.array(*[F.array(*map(F.lit, map(float, r))) for r in m])
    for left, right, flip in itertools.product((0, 13, 47), (5, 30), (False, True)):
        want = AXES[left] @ (m.T if flip else m) @ AXES[right]
        one = spark.range(1).select(R.mapped_rotation(rows, left, right, flip).alias("x"), R._by_number(rows, F.lit(left), F.lit(right), F.lit(flip)).alias("y"), rot6d_rows(F.array(*map(F.lit, six(m, True))), True).alias("z")).first()
        assert np.allclose(one.x, want) and np.allclose(one.y, want) and np.allclose(one.z, m)


def test_inspection_and_gate(frames):
    seen = {r.episode_index: r for r in inspected(frames).collect()}
    assert seen[1].best_is_expected and seen[1].frames == 29 and seen[1].expected_mean < 1e-4 < seen[1].direct_mean and seen[1].best_rmse < 1e-6
    assert not seen[2].best_is_expected and seen[2].best_mean < 1e-4 and seen[3].best_mean > R.MOST_DEGREES
    gate = R.rotation_gate(inspected(frames))
    assert gate == {"episodes": 3, "aborted": True, "reason": "best_mapping_angle_too_high", "uncertain": 1, "mixed": 2}
    some = inspected(frames.where("episode_index < 3"))
    assert R.rotation_gate(some)["reason"] == "non_expected_mappings_found"
    assert not R.rotation_gate(some, allow_mixed=True)["aborted"] and not R.rotation_gate(some, strategy="best-per-episode")["aborted"]
    assert R.rotation_gate(inspected(frames.where("false"))) == {"episodes": 0, "aborted": False, "reason": None, "uncertain": 0, "mixed": 0}


def test_repair_is_all_or_nothing(frames):
    with pytest.raises(ValueError, match="nothing was repaired"):
        R.repair_rotations(frames, inspected(frames), "state", "action", 1, 1, action_convention="column_major")
    two = frames.where("episode_index < 3")
    with pytest.raises(ValueError, match="non_expected"):
        R.repair_rotations(two, inspected(two), "state", "action", 1, 1, action_convention="column_major")
    fixed = R.repair_rotations(two, inspected(two), "state", "action", 1, 1, action_convention="column_major", strategy="best-per-episode")
    assert fixed.columns == frames.columns
    for r in inspected(fixed, action_convention="row_major", there=True).collect():
        assert r.best_is_expected and r.direct_mean < 1e-4
    assert {(len(r.action), r.action[0], r.action[-1], r.state[0]) for r in fixed.collect()} == {(8, 1.0, 9.0, 0.5)}
    one = frames.where("episode_index = 1")
    assert inspected(R.repair_rotations(one, inspected(one), "state", "action", 1, 1, action_convention="column_major"), action_convention="row_major", there=True).first().direct_mean < 1e-4


def test_marks_make_a_second_application_change_nothing(frames):
    info = {"features": {"observation.state": {"names": ["a.x", *[f"a.{c}" for c in R.COLUMN_MAJOR]]}, "action": {"names": ["b.x", *[f"b.{c}" for c in R.COLUMN_MAJOR], "b.y"]}}, "teleop_stack": {"arm_action_semantics": R.RAW_SEMANTICS, "kept": 1}}
    assert R.conventions(info, 1, 1) == ("column_major", "column_major", False) and R.conventions({}, 1, 1) == ("row_major", "column_major", False)
    marked = R.marked_info(info, 1, 1, "expected", "2024-01-01T00:00:00Z")
    assert R.conventions(marked, 1, 1) == ("row_major", "row_major", True) and marked["teleop_stack"]["kept"] == 1 and info["teleop_stack"] == {"arm_action_semantics": R.RAW_SEMANTICS, "kept": 1}
    pose = frames.where("frame_index > 0").select(F.concat(F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0)), F.slice("action", 2, 6)).alias("p"))
    first, second = (R.conventions(i, 1, 1) for i in (info, marked))
    once = pose.select(R.standardised(F.col("p"), first[1], first[2], action=True).alias("p")).collect()
    twice = pose.select(R.standardised(R.standardised(F.col("p"), first[1], first[2], action=True), second[1], second[2], action=True).alias("p")).collect()
    assert np.allclose([r.p for r in once], [r.p for r in twice]) and not np.allclose([r.p for r in once], [r.p for r in pose.collect()])


def test_smoothing_mark_keeps_the_rest(spark):
    rows = spark.createDataFrame([(1, ("raw", None)), (2, None)], "episode_index bigint, episode_metadata struct<raw_episode_id: string, smoothed_at_utc: string>")
    for _ in range(2):
        rows = R.smoothed_mark(rows, "t1")
    assert [tuple(r.episode_metadata) for r in rows.orderBy("episode_index").collect()] == [("raw", "t1"), (None, "t1")] and {r.smoothed_at_utc for r in rows.collect()} == {"t1"}


def test_best_map_statistics(spark):
    rng, rows = random.Random(9), []
    for k in range(25):
        s = turn(rng)
        c, d = math.cos(k / 50), math.sin(k / 50)
        rows.append((1, k, six(s), six(s @ np.array([[c, -d, 0], [d, c, 0], [0, 0, 1]]))))
    df = spark.createDataFrame(rows, "episode_index bigint, frame_index bigint, s array<double>, a array<double>")
    got = best_rotation_map(df, "s", "a", chunk=7).first()
    angles = np.degrees(np.arange(25) / 50)
    assert (got.degrees, got.p50, got.p95, got.largest) == pytest.approx((angles.mean(), *np.percentile(angles, [50, 95]), angles.max()), abs=1e-4)
    assert best_rotation_map(df.where("frame_index < 0"), "s", "a").count() == 0
