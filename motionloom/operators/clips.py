"""Clips of episodes as new episodes: rows, and the transactional append of clips to a stored dataset.

An append decides everything before its first byte: that source and target differ, that schemas, vector layouts and tasks
agree, which numbers the new episodes get. Frames of new episodes are then written where readers don't look, moved into place,
and last the rows of the episodes are added, in one file that appears whole. An episode exists when its row does: readers take the frames of
listed episodes only, so a crash between any two steps leaves the dataset as it was, and the next append clears what is left."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionloom.operators.ranks import in_order
from motionloom.operators.sequences import trim
from motionloom.schema import plain_names, stored_names
from motionloom.shared import cut

CHUNK = 1000
STAGED = "_staged"


def allocated(clips: DataFrame, first_episode: int = 0, first_index: int = 0) -> DataFrame:
    """clips: source_episode, start_frame, end_frame (inclusive), any number per episode -> these with episode_index, length and
    first_index, in order of source and frames. An empty range raises."""
    bad = clips.where("start_frame < 0 OR end_frame < start_frame OR start_frame IS NULL OR end_frame IS NULL OR source_episode IS NULL").count()
    if bad:
        raise ValueError(f"{bad} clips have no frames")
    sized = clips.withColumn("length", (F.col("end_frame") - F.col("start_frame") + 1).cast("bigint"))
    placed = in_order(sized, F.col("source_episode"), F.col("start_frame"), F.col("end_frame"), totals={"first_index": "length"})
    return placed.select(*clips.columns, "length", (F.col("number") + first_episode).cast("bigint").alias("episode_index"), (F.col("first_index") + first_index).cast("bigint").alias("first_index"))


def clipped(frames: DataFrame, wanted: DataFrame, fps: float) -> DataFrame:
    """frames of the clips (wanted: as allocated) as episodes of their own: frames from 0, index, timestamp and done made anew."""
    w = wanted.select(F.struct("source_episode", "start_frame", "end_frame", F.col("episode_index").alias("to"), "first_index").alias("__w"))
    inside = (F.col("episode_index") == F.col("__w.source_episode")) & F.col("frame_index").between(F.col("__w.start_frame"), F.col("__w.end_frame"))
    moved = frames.join(w, inside).withColumn("episode_index", F.col("__w.to"))
    out = trim(moved, 0, (1 << 62), fps).withColumn("index", F.col("__w.first_index") + F.col("frame_index"))
    return out.drop("__w")


def episodes_of(root: str, spark: SparkSession) -> DataFrame:
    from motionloom.schema import EPISODES

    return spark.read.schema(f"{EPISODES}, clip struct<source_dataset: string, source_episode: bigint, start_frame: bigint, end_frame: bigint, trimmed_at_utc: string>").json(f"{root}/meta/episodes")


def read_listed(spark: SparkSession, root: str) -> DataFrame:
    """The frames of the episodes that the metadata lists."""
    listed = episodes_of(root, spark).select(F.col("episode_index").alias("__listed")).distinct()
    return plain_names(spark.read.parquet(f"{root}/data")).join(listed, F.col("episode_index") == F.col("__listed"), "left_semi")


def compatible(source: dict, target: dict) -> list[str]:
    """Why clips of one dataset can't be appended to the other: layouts by group, from {group: {name: range}}, and tasks. A layout of the
    source that the target lacks is no reason, one that differs or that only the target has is."""
    found = []
    for group in ("video", "state", "action"):
        ours, theirs = source.get(group, {}), target.get(group, {})
        odd = sorted(k for k, v in theirs.items() if ours.get(k) != v)
        if odd:
            found.append(f"{group} layout differs: {', '.join(odd)}")
    if source.get("tasks") != target.get("tasks"):
        found.append("tasks differ")
    return found


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path
    return where, where(path).getFileSystem(spark._jsc.hadoopConfiguration())


def _move_files(spark: SparkSession, source: str, target: str, tag: str) -> None:
    """Every part file of a written folder into target, each by one rename, under names with the tag."""
    where, fs = _fs(spark, target)
    fs.mkdirs(where(target))
    for k, status in enumerate(fs.listStatus(where(source))):
        name = status.getPath().getName()
        if name.startswith("part-") and not fs.rename(status.getPath(), where(f"{target}/part-{tag}-{k:05d}.{name.split('.', 1)[1]}")):
            raise OSError(f"{name} can't be moved to {target}")


def clear_leftovers(spark: SparkSession, root: str) -> int:
    """Removes what an append that did not end has left: staged folders, and files of frames of episodes that are not listed. Returns
    the number of files. A file written by an append holds frames of its own episodes only."""
    where, fs = _fs(spark, root)
    gone = 0
    fs.delete(where(f"{root}/{STAGED}"), True)
    listed = episodes_of(root, spark).select(F.col("episode_index").alias("__listed")).distinct()
    frames = spark.read.parquet(f"{root}/data").select("episode_index", F.col("_metadata.file_path").alias("file")).where(F.col("file").contains("/part-clips-"))
    for row in frames.join(listed, F.col("episode_index") == F.col("__listed"), "left_anti").select("file").distinct().toLocalIterator():
        gone += bool(fs.delete(where(row.file), False))
    return gone


def append_clips(spark: SparkSession, source: str, target: str, clips: DataFrame, fps: float, at: str, layouts: tuple[dict, dict] | None = None, step=lambda name: None) -> DataFrame:
    """Appends clips (source_episode, start_frame, end_frame) of the dataset at source to that at target; returns the new rows of
    episodes. at: the time to be recorded. layouts: those of source and target, see compatible(). step is called before each step
    with its name: "frames", "chunk", "episodes"; tests stop there."""
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("source and target are the same dataset")
    if layouts and (why := compatible(*layouts)):
        raise ValueError("; ".join(why))
    ours, theirs = (spark.read.parquet(f"{d}/data").drop("chunk", "index").schema for d in (source, target))
    if {(f.name, f.dataType.simpleString()) for f in ours} - {("index", "bigint")} != {(f.name, f.dataType.simpleString()) for f in theirs} - {("index", "bigint")}:
        raise ValueError("the columns of source and target differ")
    clear_leftovers(spark, target)
    old = episodes_of(target, spark)
    next_episode, next_index = old.agg(F.coalesce(F.max("episode_index") + 1, F.lit(0)), F.coalesce(F.sum("length"), F.lit(0))).first()
    known = episodes_of(source, spark).select(F.col("episode_index").alias("source_episode"), F.col("length").alias("__all"), "tasks", "episode_metadata")
    wanted = cut(allocated(clips.select("source_episode", "start_frame", "end_frame"), next_episode, next_index).join(known, "source_episode", "left"))
    outside = wanted.where("__all IS NULL OR end_frame >= __all").count()
    if outside:
        raise ValueError(f"{outside} clips reach beyond their episodes")

    tag = f"clips-{uuid.uuid4().hex}"
    made = stored_names(clipped(read_listed(spark, source).drop("chunk", "index"), wanted, fps).withColumn("chunk", F.floor(F.col("episode_index") / CHUNK).cast("int")))
    step("frames")
    made.repartition("chunk", "episode_index").sortWithinPartitions("episode_index", "frame_index").write.partitionBy("chunk").parquet(staged := f"{target}/{STAGED}/{tag}")
    where, fs = _fs(spark, staged)
    for status in fs.listStatus(where(staged)):
        name = status.getPath().getName()
        if name.startswith("chunk="):
            step("chunk")
            _move_files(spark, f"{staged}/{name}", f"{target}/data/{name}", tag)
    clip = F.struct(F.lit(source).alias("source_dataset"), "source_episode", F.col("start_frame").cast("bigint").alias("start_frame"), F.col("end_frame").cast("bigint").alias("end_frame"), F.lit(at).alias("trimmed_at_utc"))
    rows = wanted.select("episode_index", "tasks", "length", "episode_metadata", clip.alias("clip"))
    rows.coalesce(1).write.json(f"{target}/{STAGED}/{tag}-episodes")
    step("episodes")
    _move_files(spark, f"{target}/{STAGED}/{tag}-episodes", f"{target}/meta/episodes", tag)
    fs.delete(where(f"{target}/{STAGED}"), True)
    return rows
