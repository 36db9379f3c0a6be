"""State and action vectors from logged payloads. All are column expressions; null where a required part is missing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from motionloom.functions.text import named_values
from motionloom.functions.vectors import action_quaternion_to_rot6d, quaternion_to_rot6d, xyz_to_state_frame


def exact(v: Column, n: int) -> Column:
    """v if it has n numbers, none of them null."""
    return F.when((F.size(v) == n) & ~F.exists(v, lambda x: x.isNull()), v)


def state_vector(robot: Column) -> Column:
    """26 numbers: seven arm joints, position, two rows of rotation, ten hand joints."""
    pose = robot["arm_ee_pose"]
    parts = [exact(robot["arm_joint_positions"], 7), exact(pose["position_xyz"], 3), quaternion_to_rot6d(pose["quaternion_xyzw"]), exact(robot["hand_joint_positions"], 10)]
    return F.concat(*parts)


def action_vector(action: Column, hand_names: Sequence[str]) -> Column:
    """19 numbers: position and rotation in the state's frame, ten hand joints by name."""
    ee, hand = action["ee_target"], action["hand_target"]
    position = exact(ee["position_xyz"], 3)
    return F.concat(F.when(position.isNotNull(), xyz_to_state_frame(position)), action_quaternion_to_rot6d(ee["quaternion_xyzw"]), named_values(hand["joint_names"], hand["joint_positions"], hand_names))


def plain_state_vector(robot: Column) -> Column:
    """Joints, hand, position and quaternion, as they come; parts that are missing are left out."""
    pose, none = robot["arm_ee_pose"], F.array().cast("array<double>")
    return F.concat(*[F.coalesce(x, none) for x in (robot["arm_joint_positions"], robot["hand_joint_positions"], pose["position_xyz"], pose["quaternion_xyzw"])])


def plain_action_vector(action: Column) -> Column:
    """Position, quaternion, gripper and hand joints in the order of their names; parts that are missing are left out."""
    ee, hand, none = action["ee_target"], action["hand_target"], F.array().cast("array<double>")
    pairs = F.array_sort(F.arrays_zip(hand["joint_names"].alias("n"), hand["joint_positions"].alias("v")))
    grip = action["gripper"]["normalized_position"]
    return F.concat(*[F.coalesce(x, none) for x in (ee["position_xyz"], ee["quaternion_xyzw"], F.when(grip.isNotNull(), F.array(grip)), F.transform(pairs, lambda p: p["v"]))])


def first_reason(checks: Sequence[tuple[str, Column]]) -> Column:
    """The name of the first check that fails; null where all hold."""
    out = F.lit(None).cast("string")
    for name, ok in reversed(list(checks)):
        out = F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)).otherwise(out)
    return out
