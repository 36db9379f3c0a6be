"""Schemas of capture logs, frames and derived tables, and the catalog of vector slices."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EE = "struct<position_xyz: array<double>, quaternion_xyzw: array<double>>"
VIDEO = "struct<camera_name: string, relative_path: string, frame_index: int, width: int, height: int, monotonic_ts_s: double>"
ACTION = f"struct<ee_target: {EE}, hand_target: struct<joint_names: array<string>, joint_positions: array<double>>, gripper: struct<normalized_position: double>>"
ROBOT = f"struct<arm_joint_positions: array<double>, hand_joint_positions: array<double>, arm_ee_pose: {EE}, raw_snapshot: struct<hand_state: struct<joint_names: array<string>>>>"
TIMES = "monotonic_ts_s double, source_ts_s double, capture_ts_s double"
LOGS = {
    "episode": "episode_id string, task_instruction string, task_name string, trial_mode string, policy_id string, policy_version string, success boolean, outcome string, outcome_reason string, robot_embodiment string, robot_name string",
    "frames": f"{TIMES}, teleop_frame_id bigint, action {ACTION}, robot {ROBOT}, videos array<{VIDEO}>",
    "actions": f"{TIMES}, frame_id bigint, safe_action {ACTION}, commanded_action {ACTION}",
    "robot": f"{TIMES}, arm_joint_positions array<double>, hand_joint_positions array<double>, arm_ee_pose {EE}",
    "video": "camera_name string, relative_path string, frame_index int, width int, height int, monotonic_ts_s double, capture_ts_s double",
}
EPISODES = "episode_index bigint, tasks array<string>, length bigint, episode_metadata struct<raw_episode_id: string, source_date: string, data_path: string, video_paths: map<string, string>, smoothed_at_utc: string>"
TASKS = "task_index bigint, task string"
ISSUE = "struct<episode_index: bigint, source_date: string, severity: string, code: string, message: string, metric: string, value: double>"

FRAME_COLUMNS = ("index", "episode_index", "frame_index", "task_index", "timestamp", "state", "action", "next.done", "next.reward")


@dataclass(frozen=True)
class Slice:
    """Half-open range of dimensions of a vector column."""

    column: str
    start: int
    end: int

    def of(self) -> Column:
        return F.slice(F.col(self.column), self.start + 1, self.end - self.start)


#: Groups of the 26-dimensional state and the 19-dimensional action.
SLICES = {
    "arm_joint": Slice("state", 0, 7),
    "eef_state": Slice("state", 7, 16),
    "eef_xyz_state": Slice("state", 7, 10),
    "eef_rot6d_state": Slice("state", 10, 16),
    "hand_state": Slice("state", 16, 26),
    "eef_action": Slice("action", 0, 9),
    "eef_xyz_action": Slice("action", 0, 3),
    "eef_rot6d_action": Slice("action", 3, 9),
    "hand_action": Slice("action", 9, 19),
}


def slices_from_modality(modality: dict) -> dict[str, Slice]:
    """{state|action: {name: {start, end}}} -> Slice by name."""
    return {f"{name}_{column}": Slice(column, int(r["start"]), int(r["end"])) for column in ("state", "action") for name, r in modality.get(column, {}).items()}


def indices_of(names: list[str], wanted: list[str], contiguous: bool = False) -> list[int]:
    """Places of feature names, by full name or by the part after the last dot; a missing name, or a gap where none may be, raises."""
    short = {n.rsplit(".", 1)[-1]: i for i, n in reversed(list(enumerate(names)))}
    full = {n: i for i, n in reversed(list(enumerate(names)))}
    found = [full.get(w, short.get(w, -1)) for w in wanted]
    if -1 in found:
        raise KeyError(f"no feature named {wanted[found.index(-1)]}")
    if contiguous and found != list(range(found[0], found[0] + len(found))):
        raise ValueError(f"features {wanted} are not contiguous")
    return found


def plain_names(frames: DataFrame) -> DataFrame:
    """Dotted columns of a stored frame table under the names that the operators use; stored_names() is the way back."""
    return frames.withColumnsRenamed({"observation.state": "state", "next.done": "done", "next.reward": "reward", "annotation.human.validity": "validity", "annotation.human.action.task_description": "task_description"})


def stored_names(frames: DataFrame) -> DataFrame:
    return frames.withColumnsRenamed({"state": "observation.state", "done": "next.done", "reward": "next.reward", "validity": "annotation.human.validity", "task_description": "annotation.human.action.task_description"})
