"""Repairs of stored datasets: inspect all episodes, gate, write all or none, mark the metadata, inspect again.

The repaired frames are written beside the old ones together with a mark, and both change places by renames; the first old
table stays as a backup. The mark in the data is what a repair after a crash goes by: frames that carry it are not mapped
again, and only the metadata is brought up to date. Metadata that carries its own mark ends a second repair at once."""

from __future__ import annotations

import copy
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionloom.operators import repair as P
from motionloom.operators import rotation as R
from motionloom.schema import plain_names, stored_names
from motionloom.shared import cut
from motionloom.sources.datasets import _put
from motionloom.sources.logs import _exists, read_json

MARK = "_repairs.json"


def _marks(spark: SparkSession, path: str) -> list[str]:
    """The repairs that the data have had. Spark's readers skip a file of such a name, which is why it may lie there."""
    if not _exists(spark, path):
        return []
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    file = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8"))
    finally:
        file.close()


def _swap(spark: SparkSession, root: str, frames: DataFrame, done: list[str], backup: str) -> None:
    """Frames in the place of root/data, with the mark; the data of before the first repair stays under the backup's name."""
    p = spark._jvm.org.apache.hadoop.fs.Path
    fs = p(root).getFileSystem(spark._jsc.hadoopConfiguration())
    data, new = f"{root}/data", f"{root}/.data-{uuid.uuid4().hex}"
    stored_names(frames).repartition("chunk", "episode_index").sortWithinPartitions("episode_index", "frame_index").write.partitionBy("chunk").parquet(new)
    _put(spark, f"{new}/{MARK}", json.dumps(done))
    keep = not fs.exists(p(data + backup))
    aside = data + backup if keep else f"{root}/.data-{uuid.uuid4().hex}"
    if not fs.rename(p(data), p(aside)):
        raise OSError(f"{data} can't be moved aside")
    if not fs.rename(p(new), p(data)):
        fs.rename(p(aside), p(data))
        raise OSError(f"{data} can't be replaced")
    if not keep:
        fs.delete(p(aside), True)


def _repair(spark: SparkSession, root: str, kind: str, inspect: Callable, gate: Callable, fix: Callable, mark: Callable, backup: str, step: Callable) -> dict:
    p = spark._jvm.org.apache.hadoop.fs.Path
    data, olds = p(f"{root}/data"), p(f"{root}/data{backup}")
    fs = data.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(data) and fs.exists(olds):  # a crash between the two renames
        fs.rename(olds, data)
    info = read_json(spark, f"{root}/meta/info.json")
    done = _marks(spark, f"{root}/data/{MARK}")
    if kind not in done:
        frames = plain_names(spark.read.parquet(f"{root}/data"))
        seen = cut(inspect(frames, False))
        found = gate(seen)
        if found["aborted"]:
            return found | {"applied": False}
        step("data")
        _swap(spark, root, fix(frames, seen), [*done, kind], backup)
    step("info")
    _put(spark, f"{root}/meta/info.json", json.dumps(mark(info), indent=2, sort_keys=True), backup=True)
    after = inspect(plain_names(spark.read.parquet(f"{root}/data")), True)
    n, good = after.agg(F.count(F.lit(1)), F.count_if("good")).first()
    return {"episodes": n, "aborted": False, "reason": None, "applied": True, "good_after": good}


def repair_stored_rotations(spark: SparkSession, root: str, state_at: int, action_at: int, at: str, strategy: str = "expected", allow_mixed: bool = False, limit: float = R.MOST_DEGREES, backup: str = ".bak_eef9d_fix", step: Callable = lambda name: None) -> dict:
    """episodes, aborted, reason, applied, and good_after: episodes whose best map is none after the repair."""
    by_state, by_action, there = R.conventions(read_json(spark, f"{root}/meta/info.json"), state_at, action_at)
    if there:
        return {"aborted": False, "reason": "already_in_state_frame", "applied": False}

    def inspect(frames: DataFrame, after: bool) -> DataFrame:
        six = frames.select("episode_index", "frame_index", F.slice("state", state_at + 1, 6).alias("s"), F.slice("action", action_at + 1, 6).alias("a"))
        seen = R.inspect_rotations(six, "s", "a", *(("row_major", "row_major", True) if after else (by_state, by_action, False)))
        return seen.withColumn("good", F.col("best_is_expected"))

    return _repair(
        spark, root, "rotations", inspect, lambda seen: R.rotation_gate(seen, limit, strategy, allow_mixed),
        lambda frames, seen: R.repair_rotations(frames, seen, "state", "action", state_at, action_at, by_state, by_action, False, strategy, allow_mixed, limit),
        lambda info: R.marked_info(info, state_at, action_at, strategy, at), backup, step,
    )


def repair_stored_positions(spark: SparkSession, root: str, state_at: int, action_at: int, at: str, limit: float = P.OFFSET_RMSE, backup: str = ".bak_eef_xyz_fix", step: Callable = lambda name: None) -> dict:
    """The same for positions whose axes are in the raw frame's order."""
    if "eef_xyz_repair" in (read_json(spark, f"{root}/meta/info.json").get("teleop_stack") or {}):
        return {"aborted": False, "reason": "already_repaired", "applied": False}

    def inspect(frames: DataFrame, after: bool) -> DataFrame:
        three = frames.select("episode_index", "frame_index", F.slice("state", state_at + 1, 3).alias("s"), F.slice("action", action_at + 1, 3).alias("a"))
        return P.inspect_positions(three, "s", "a").withColumn("good", F.col("best_is_identity"))

    def gate(seen: DataFrame) -> dict:
        n, bad = seen.count(), P.refused(seen, limit).count()
        return {"episodes": n, "aborted": bad > 0, "reason": "uncertain_or_non_expected_xyz_mapping" if bad else None, "uncertain": bad}

    def mark(info: dict) -> dict:
        out = copy.deepcopy(info)
        out.setdefault("teleop_stack", {})["eef_xyz_repair"] = {"mapping": "[z,x,y]", "offset_applied": False, "repaired_at_utc": at}
        return out

    return _repair(spark, root, "positions", inspect, gate, lambda frames, seen: P.repair_positions(frames, seen, "action", action_at, limit), mark, backup, step)
