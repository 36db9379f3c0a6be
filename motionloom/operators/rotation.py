"""Rotations of recorded poses: the convention they are stored in, inspection against a map of frames, and a gated repair.

A repair inspects every episode, gates on all of them, maps all or none, marks the metadata, and inspects again. The mark is
what makes a second repair, or a second standardisation, change nothing."""

from __future__ import annotations

import copy
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motionloom.functions.vectors import finite, let, rot6d_rows, rotation_between, rows_to_rot6d
from motionloom.operators.mapping import best_rotation_map, signed_permutations

# Names of stored components, the map from the action's frame to the state's, marks in the metadata, the limit.
ROW_MAJOR = ("r00", "r01", "r02", "r10", "r11", "r12")
COLUMN_MAJOR = ("r00", "r10", "r20", "r01", "r11", "r21")
EXPECTED_LEFT, EXPECTED_RIGHT = "+z,+x,+y", "-y,-z,+x"
CONVENTION = "row_major_first_two_rows_[r00,r01,r02,r10,r11,r12]"
RAW_SEMANTICS, SEMANTICS = "absolute_wrist_pose_xyz_rot6d_target", "absolute_wrist_pose_xyz_rot6d_target_in_state_frame"
MOST_DEGREES = 20.0


def matrix_name(number: int) -> str:
    """Rows of a signed axis matrix, as axes with signs."""
    perm, signs = signed_permutations()[number]
    return ",".join("-+"[s > 0] + "xyz"[p] for p, s in zip(perm, signs, strict=True))


NUMBERS = {matrix_name(n): n for n in range(48)}


def convention_of(names: Sequence[str], start: int, default: str) -> str:
    """row_major or column_major, from the last parts of the six feature names from start on; default if they say neither."""
    found = tuple(str(n).rsplit(".", 1)[-1] for n in names[start : start + 6])
    return {ROW_MAJOR: "row_major", COLUMN_MAJOR: "column_major"}.get(found, default)


def in_state_frame(info: dict) -> bool:
    """Whether the metadata says that the actions' rotations are in the state's frame already."""
    marks = info.get("teleop_stack") if isinstance(info, dict) else None
    return isinstance(marks, dict) and marks.get("rot6d_convention") == CONVENTION and isinstance(marks.get("action_rot6d_frame_transform"), dict) and "in_state_frame" in str(marks.get("arm_action_semantics") or "")


def conventions(info: dict, state_start: int, action_start: int) -> tuple[str, str, bool]:
    """Of state and action, and whether the action is in the state's frame. Without names, states and marked actions are by rows."""
    names = lambda c: (info.get("features") or {}).get(c, {}).get("names") or []
    there = in_state_frame(info)
    return convention_of(names("observation.state"), state_start, "row_major"), convention_of(names("action"), action_start, "row_major" if there else "column_major"), there


def mapped_rotation(rows: Column, left: int, right: int, transpose: bool = False) -> Column:
    """left x rows x right, by numbers of signed axis matrices: each element is one element of rows with a sign."""
    (p, s), (q, t) = signed_permutations()[left], signed_permutations()[right]
    at = lambda r, i, k: r[k][i] if transpose else r[i][k]
    back = [q.index(column) for column in range(3)]
    return let(rows, lambda r: F.array(*[F.array(*[at(r, p[i], back[c]) * F.lit(float(s[i] * t[back[c]])) for c in range(3)]) for i in range(3)]))


def _by_number(rows: Column, left: Column, right: Column, transpose: Column) -> Column:
    """The same where the numbers are columns."""
    table = lambda f: F.array(*[F.array(*map(F.lit, f(*x))) for x in signed_permutations()])
    p, s = F.get(table(lambda p, _: p), left), F.get(table(lambda _, s: map(float, s)), left)
    back, t = F.get(table(lambda q, _: [q.index(c) for c in range(3)]), right), F.get(table(lambda q, t: [float(t[q.index(c)]) for c in range(3)]), right)
    at = lambda r, i, k: F.when(transpose, F.get(F.get(r, k), i)).otherwise(F.get(F.get(r, i), k))
    return let(rows, lambda r: F.array(*[F.array(*[at(r, p[i], back[c]) * s[i] * t[c] for c in range(3)]) for i in range(3)]))


def in_frame(rows: Column, there: bool) -> Column:
    """The action's rotation in the state's frame, by the fixed map unless it is there."""
    return rows if there else mapped_rotation(rows, NUMBERS[EXPECTED_LEFT], NUMBERS[EXPECTED_RIGHT])


def standardised(pose: Column, convention: str = "row_major", there: bool = True, action: bool = False) -> Column:
    """Nine numbers (position, rotation) with the rotation by rows in the state's frame. State poses that are by rows stay as they
    are; shorter vectors stay too. The position is never changed."""
    rows = rot6d_rows(F.slice(pose, 4, 6), convention == "column_major")
    if not action and convention == "row_major":
        return pose
    new = F.concat(F.slice(pose, 1, 3), rows_to_rot6d(in_frame(rows, there) if action else rows))
    return F.when(F.size(pose) >= 9, new).otherwise(pose)


def inspect_rotations(frames: DataFrame, state: str, action: str, state_convention: str = "row_major", action_convention: str = "row_major", there: bool = False, key: str = "episode_index") -> DataFrame:
    """Key, frames, direct_mean, direct_p95, expected_mean, expected_p95, expected_rmse, best_left, best_right, best_transpose,
    best_mean, best_p95, best_rmse, best_is_expected. state, action: six numbers each.

    Angles in degrees, over the frames whose values are finite. One aggregation for the given maps, and one search by episode."""
    s, a = rot6d_rows(F.col(state), state_convention == "column_major"), rot6d_rows(F.col(action), action_convention == "column_major")
    known = F.forall(F.concat(state, action), lambda x: finite(x).isNotNull())
    rows = frames.where(known).select(key, "frame_index", s.alias("s"), a.alias("a")).withColumn("m", in_frame(F.col("a"), there))
    gap = F.aggregate(F.zip_with(rows_to_rot6d(F.col("s")), rows_to_rot6d(F.col("m")), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda t, x: t + x)
    judged = rows.select(key, rotation_between(F.col("s"), F.col("a")).alias("d"), rotation_between(F.col("s"), F.col("m")).alias("e"), gap.alias("g"))
    p95 = lambda c: F.percentile(c, F.lit(0.95))
    errors = judged.groupBy(F.col(key).alias("ik")).agg(
        F.count(F.lit(1)).alias("frames"), F.avg("d").alias("direct_mean"), p95("d").alias("direct_p95"), F.avg("e").alias("expected_mean"), p95("e").alias("expected_p95"), F.sqrt(F.avg("g") / 6).alias("expected_rmse")
    )
    best = best_rotation_map(rows.select(key, "frame_index", rows_to_rot6d(F.col("s")).alias("s"), rows_to_rot6d(F.col("a")).alias("a")), "s", "a", key)
    left, right = ("+x,+y,+z",) * 2 if there else (EXPECTED_LEFT, EXPECTED_RIGHT)
    minus = lambda n: NUMBERS[",".join("+-"[x[0] == "+"] + x[1] for x in n.split(","))]
    # a map and the one with both signs turned are the same
    same = ((F.col("left") == NUMBERS[left]) & (F.col("right") == NUMBERS[right])) | ((F.col("left") == minus(left)) & (F.col("right") == minus(right)))
    return errors.join(best, F.col("ik") == F.col(key)).select(
        key, "frames", "direct_mean", "direct_p95", "expected_mean", "expected_p95", "expected_rmse", F.col("left").alias("best_left"), F.col("right").alias("best_right"), F.col("transpose").alias("best_transpose"),
        F.col("degrees").alias("best_mean"), F.col("p95").alias("best_p95"), F.col("rot6d_rmse").alias("best_rmse"), (~F.col("transpose") & same).alias("best_is_expected"),
    )


def rotation_gate(inspected: DataFrame, limit: float = MOST_DEGREES, strategy: str = "expected", allow_mixed: bool = False) -> dict:
    """episodes, aborted, reason, uncertain, mixed: whether the inspection allows a repair. An episode whose best map is off by more
    than limit forbids any repair; one whose best map is another than the expected forbids that by the expected one."""
    mean = F.col("best_mean")
    n, uncertain, mixed = inspected.agg(F.count(F.lit(1)), F.count_if(mean.isNull() | F.isnan(mean) | (mean > limit)), F.count_if(~F.col("best_is_expected"))).first()
    reason = "best_mapping_angle_too_high" if uncertain else "non_expected_mappings_found" if mixed and strategy == "expected" and not allow_mixed else None
    return {"episodes": n, "aborted": reason is not None, "reason": reason, "uncertain": uncertain, "mixed": mixed}


def repair_rotations(frames: DataFrame, inspected: DataFrame, state: str, action: str, state_at: int, action_at: int, state_convention: str = "row_major", action_convention: str = "row_major", there: bool = False, strategy: str = "expected", allow_mixed: bool = False, limit: float = MOST_DEGREES, key: str = "episode_index") -> DataFrame:
    """frames with the six numbers from state_at and action_at (0 is the first) by rows in the state's frame: by the fixed map, or with
    strategy "best-per-episode" by each episode's best one. All or nothing: a refusal of the gate raises."""
    gate = rotation_gate(inspected, limit, strategy, allow_mixed)
    if gate["aborted"]:
        raise ValueError(f"{gate['reason']}: {gate['uncertain']} uncertain and {gate['mixed']} mixed of {gate['episodes']} episodes; nothing was repaired")
    put = lambda v, at, new: F.concat(F.slice(v, 1, at), new, F.slice(v, F.lit(at + 7), F.greatest(F.size(v) - at - 6, F.lit(0))))
    s = rot6d_rows(F.slice(state, state_at + 1, 6), state_convention == "column_major")
    a = rot6d_rows(F.slice(action, action_at + 1, 6), action_convention == "column_major")
    if strategy == "expected":
        return frames.withColumns({state: put(F.col(state), state_at, rows_to_rot6d(s)), action: put(F.col(action), action_at, rows_to_rot6d(in_frame(a, there)))})
    missing = frames.select(key).distinct().join(inspected, key, "left_anti").count()
    if missing:
        raise KeyError(f"{missing} episodes were not inspected")
    maps = inspected.select(F.col(key).alias("__key"), F.struct("best_left", "best_right", "best_transpose").alias("__map"))
    joined = frames.join(maps, F.col(key) == F.col("__key"))
    turned = _by_number(a, F.col("__map.best_left"), F.col("__map.best_right"), F.col("__map.best_transpose"))
    return joined.withColumns({state: put(F.col(state), state_at, rows_to_rot6d(s)), action: put(F.col(action), action_at, rows_to_rot6d(turned))}).select(*frames.columns)


def marked_info(info: dict, state_at: int, action_at: int, strategy: str, at: str) -> dict:
    """The metadata after a repair: feature names by rows, semantics, convention, the map and when it was applied."""
    out = copy.deepcopy(info)
    for column, start in (("observation.state", state_at), ("action", action_at)):
        names = (out.setdefault("features", {}).get(column) or {}).get("names")
        if names and len(names) >= start + 6:
            prefix = str(names[start]).rsplit(".", 1)[0]
            out["features"][column]["names"] = [*names[:start], *[f"{prefix}.{r}" for r in ROW_MAJOR], *names[start + 6 :]]
    marks = out.setdefault("teleop_stack", {})
    if marks.get("arm_action_semantics", RAW_SEMANTICS) == RAW_SEMANTICS:
        marks["arm_action_semantics"] = SEMANTICS
    marks["rot6d_convention"] = CONVENTION
    marks["action_rot6d_frame_transform"] = {"formula": "R_state ~= L @ R_action @ R", "left": EXPECTED_LEFT, "right": EXPECTED_RIGHT} if strategy == "expected" else {"formula": "best map of each episode"}
    marks["eef9d_repair"] = {"strategy": strategy, "repaired_at_utc": at}
    return out


def smoothed_mark(episodes: DataFrame, at: str, nested: str = "episode_metadata", field: str = "smoothed_at_utc") -> DataFrame:
    """episodes with the time of smoothing, as a column and inside the nested metadata, whose other fields stay. Rows without nested
    metadata get one with this field alone."""
    empty = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in episodes.schema[nested].dataType.fields])
    return episodes.withColumns({field: F.lit(at), nested: F.coalesce(F.col(nested), empty).withField(field, F.lit(at))})
