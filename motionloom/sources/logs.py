"""Readers of capture logs, metadata and tables; schemas are given, never inferred from data."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from motionloom.operators.ranks import in_order
from motionloom.schema import LOGS


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop)
    return found is not None and len(found) > 0


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; blank lines are skipped, a missing path is empty, a bad line fails the query."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path, mode="FAILFAST")


def read_json(spark: SparkSession, path: str) -> dict:
    """One small metadata object, on the driver."""
    return json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()))


def load_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parquet or CSV by its ending; a missing path is empty."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).csv(path, header=True) if path.rstrip("/").endswith(".csv") else spark.read.schema(schema).parquet(path)


def read_capture(spark: SparkSession, session_dir: str, stream: str) -> DataFrame:
    """One stream of all episodes of a session, with episode_dir and record_no (the place of the line in its file, from 0, however
    files are split or packed into tasks)."""
    name = "episode.json" if stream == "episode" else f"{stream}.jsonl"
    path = f"{session_dir.rstrip('/')}/episodes/*/{name}"
    if not _exists(spark, path):
        return spark.createDataFrame([], f"{LOGS[stream]}, episode_dir string, record_no bigint")
    rows = spark.read.schema(LOGS[stream]).json(path, mode="FAILFAST", multiLine=stream == "episode")
    place = F.regexp_extract(F.col("_metadata.file_path"), r"/episodes/([^/]+)/[^/]+$", 1)
    rows = rows.select("*", place.alias("episode_dir"), F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__at"), F.monotonically_increasing_id().alias("__no"))
    number = F.row_number().over(Window.partitionBy("episode_dir", "__file").orderBy("__at", "__no")) - 1
    return rows.withColumn("record_no", number.cast("bigint")).drop("__file", "__at", "__no")


def episode_numbers(episodes: DataFrame) -> DataFrame:
    """Adds episode_index in order of directories, before any episode is skipped, so that skips leave gaps."""
    found = in_order(episodes.select(F.col("episode_dir").alias("__dir")).distinct(), F.col("__dir"), number="episode_index")
    return episodes.join(found, F.col("episode_dir") == F.col("__dir")).drop("__dir")


def stream_records(frames: DataFrame, dedicated: DataFrame, key: str, has_payload: Column) -> DataFrame:
    """Payloads embedded in frames, for episodes that have any; else the dedicated log."""
    embedded = frames.where(has_payload)
    own = embedded.select(F.col(key).alias("__k")).distinct()
    return embedded.unionByName(dedicated.join(own, F.col(key) == F.col("__k"), "left_anti"), allowMissingColumns=True)


def video_payloads(record: str = "videos", single: str = "camera_name") -> Callable[[DataFrame], DataFrame]:
    """One row per video of a record: the record itself if it names a camera, else those in its list."""

    def run(rows: DataFrame) -> DataFrame:
        fields = ("camera_name", "relative_path", "frame_index", "width", "height", "monotonic_ts_s")
        have = [c for c in fields if c in rows.columns]
        own = F.array(F.struct(*[(F.col(c) if c in have else F.lit(None)).alias(c) for c in fields]))
        lists = F.col(record) if record in rows.columns else F.lit(None).cast("array<struct<camera_name: string, relative_path: string, frame_index: int, width: int, height: int, monotonic_ts_s: double>>")
        videos = F.when(F.col(single).isNotNull(), own).otherwise(lists) if single in rows.columns else lists
        rest = [c for c in rows.columns if c not in (*fields, record)]
        return rows.select(*rest, F.explode(videos).alias("v")).select(*rest, *[f"v.{c}" for c in fields])

    return run


def mission_task(spark: SparkSession, path: str) -> str | None:
    """The task that the nearest mission file above path names in a line `- Mission: ...`."""
    at = path.rstrip("/")
    while "/" in at:
        at = at.rsplit("/", 1)[0]
        if at and _exists(spark, f"{at}/MISSION.md"):
            for r in spark.read.text(f"{at}/MISSION.md").collect():
                if r.value.strip().startswith("- Mission:"):
                    return r.value.split(":", 1)[1].strip() or None
    return None


def find_datasets(spark: SparkSession, root: str) -> list[str]:
    """Directories under root, up to three levels down, that hold meta/info.json."""
    out = []
    for depth in range(4):
        pattern = spark._jvm.org.apache.hadoop.fs.Path(root.rstrip("/") + "/*" * depth + "/meta/info.json")
        fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
        out += [s.getPath().getParent().getParent().toString() for s in fs.globStatus(pattern) or []]
    return sorted(set(out))


def non_finite_paths(text: Column) -> Column:
    """Paths in a JSON text of numbers that are NaN or infinite (array of strings)."""

    @F.pandas_udf("array<string>")
    def walk(texts: pd.Series) -> pd.Series:
        def rec(v, at):
            if isinstance(v, float) and (v != v or v in (float("inf"), float("-inf"))):
                return [at]
            items = v.items() if isinstance(v, dict) else enumerate(v) if isinstance(v, list) else ()
            return [p for k, w in items for p in rec(w, f"{at}.{k}" if at else str(k))]

        return texts.map(lambda x: rec(json.loads(x), "") if x else [])

    return walk(text)
