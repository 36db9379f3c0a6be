"""Repairs of stored datasets, and crashes between their steps."""

import json
import random

import numpy as np
import pytest

from motionloom.operators import rotation as R
from motionloom.operators.mapping import signed_axis_matrices
from motionloom.sources import datasets, repairs
from motionloom.sources.logs import read_json

AXES = signed_axis_matrices()


def turn(rng):
    q = np.linalg.qr(np.array([[rng.gauss(0, 1) for _ in range(3)] for _ in range(3)]))[0]
    return q if np.linalg.det(q) > 0 else -q


@pytest.fixture
def stored(spark, tmp_path):
    """States by rows: position and rotation. Actions in their own frame: position in raw order, rotation by columns."""
    rng, rows = random.Random(5), []
    left, right = AXES[R.NUMBERS[R.EXPECTED_LEFT]], AXES[R.NUMBERS[R.EXPECTED_RIGHT]]
    for e in range(2):
        for k in range(12):
            s, p = turn(rng), [rng.random() for _ in range(3)]
            a = left.T @ s @ right.T
            rows.append((e, k, [*p, *map(float, [*s[0], *s[1]])], [p[1], p[2], p[0], *map(float, [*a[:, 0], *a[:, 1]]), 5.0]))
    frames = spark.createDataFrame(rows, "episode_index bigint, frame_index bigint, state array<double>, action array<double>")
    lengths = datasets.write_frames(frames, root := f"file://{tmp_path}/set")
    datasets.write_metadata(spark, root, lengths, spark.createDataFrame([(0, "pick")], "task_index bigint, task string"), 10.0, {"action": {"names": ["x", "y", "z", *[f"r.{c}" for c in R.COLUMN_MAJOR], "g"]}}, {})
    return root


def content(spark, root):
    return sorted((r.episode_index, r.frame_index, *np.round(r.state, 6), *np.round(r.action, 6)) for r in datasets.read_frames(spark, root).collect())


def test_both_repairs_and_their_repetition(spark, stored):
    before = content(spark, stored)
    got = repairs.repair_stored_rotations(spark, stored, 3, 3, "t")
    assert got["applied"] and got["good_after"] == got["episodes"] == 2
    assert repairs.repair_stored_rotations(spark, stored, 3, 3, "t")["reason"] == "already_in_state_frame"
    got = repairs.repair_stored_positions(spark, stored, 0, 0, "t")
    assert got["applied"] and got["good_after"] == 2
    assert repairs.repair_stored_positions(spark, stored, 0, 0, "t")["reason"] == "already_repaired"
    assert all(r[2:11] == r[11:20] and r[20] == 5.0 for r in content(spark, stored))
    marks = read_json(spark, f"{stored}/meta/info.json")
    assert marks["teleop_stack"]["rot6d_convention"] == R.CONVENTION and marks["features"]["action"]["names"][3] == "r.r00" and marks["total_frames"] == 24
    kept = [tuple(np.round(r["action"], 6)) for r in spark.read.parquet(f"{stored}/data.bak_eef9d_fix").collect()]
    assert sorted(kept) == sorted(tuple(r[11:]) for r in before)


@pytest.mark.parametrize("at", ["data", "info"])
def test_crash_between_steps(spark, stored, at):
    def step(name):
        if name == at:
            raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        repairs.repair_stored_rotations(spark, stored, 3, 3, "t", step=step)
    assert len(content(spark, stored)) == 24 and not R.in_state_frame(read_json(spark, f"{stored}/meta/info.json"))
    assert repairs.repair_stored_rotations(spark, stored, 3, 3, "t")["good_after"] == 2  # mapped once, not twice


def test_refusal_writes_nothing(spark, stored):
    before = content(spark, stored)
    got = repairs.repair_stored_rotations(spark, stored, 3, 3, "t", limit=-1.0)
    assert got == {"episodes": 2, "aborted": True, "reason": "best_mapping_angle_too_high", "uncertain": 2, "mixed": 0, "applied": False}
    assert repairs.repair_stored_positions(spark, stored, 0, 3, "t")["aborted"] and content(spark, stored) == before
    assert json.dumps(read_json(spark, f"{stored}/meta/info.json")).count("teleop_stack") == 0
