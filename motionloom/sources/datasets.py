"""Datasets on storage: frames partitioned by chunk, metadata files, tables, atomic rewrites, date views, manifests."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionloom.operators.incremental import date_view, merge_manifest
from motionloom.operators.sequences import offsets
from motionloom.schema import plain_names, stored_names

CHUNK = 1000


def read_frames(spark: SparkSession, root: str) -> DataFrame:
    return plain_names(spark.read.parquet(f"{root}/data"))


def write_frames(frames: DataFrame, root: str, mode: str = "errorifexists") -> DataFrame:
    """Adds the running global index and writes frames by chunk; returns the lengths of the episodes."""
    lengths = frames.groupBy("episode_index").agg(F.count(F.lit(1)).alias("length"))
    starts = offsets(lengths, "episode_index", "length").select(F.col("episode_index").alias("__e"), "start")
    rows = frames.join(starts, F.col("episode_index") == F.col("__e")).withColumn("index", F.col("start") + F.col("frame_index")).drop("__e", "start")
    chunk = F.floor(F.col("episode_index") / CHUNK).cast("int")
    stored_names(rows.withColumn("chunk", chunk)).repartition("chunk", "episode_index").sortWithinPartitions("episode_index", "frame_index").write.mode(mode).partitionBy("chunk").parquet(f"{root}/data")
    return lengths


def _put(spark: SparkSession, path: str, text: str, backup: bool = False) -> None:
    """Writes a small file; the first time, the old one stays as .bak. The old one is moved aside before the new one takes its
    place and comes back if that fails, so that at no time neither is there."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    tmp = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp)
    out.write(bytearray(text.encode()))
    out.close()
    kept = jvm.org.apache.hadoop.fs.Path(path + ".bak")
    had = fs.exists(target)
    keep = backup and not fs.exists(kept)
    aside = kept if keep else jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.old")
    if had and not fs.rename(target, aside):
        raise OSError(f"{path} can't be moved aside")
    if not fs.rename(tmp, target):
        if had:
            fs.rename(aside, target)
        raise OSError(f"{path} can't be written")
    if had and not keep:
        fs.delete(aside, False)


def write_metadata(spark: SparkSession, root: str, episodes: DataFrame, tasks: DataFrame, fps: float, features: dict, modality: dict) -> dict:
    """info, modality, tasks and episodes; the totals are aggregates, only small rows reach the driver."""
    t = episodes.agg(F.count(F.lit(1)).alias("e"), F.coalesce(F.sum("length"), F.lit(0)).alias("f"), F.count_distinct(F.floor(F.col("episode_index") / CHUNK)).alias("c")).first()
    info = {"total_episodes": t["e"], "total_frames": t["f"], "total_tasks": tasks.count(), "total_chunks": t["c"], "chunks_size": CHUNK, "fps": fps, "splits": {"train": f"0:{t['e']}"}, "data_path": "data/chunk-{episode_chunk:03d}/episode_{episode_index:06d}.parquet", "features": features}
    _put(spark, f"{root}/meta/info.json", json.dumps(info, indent=2, sort_keys=True))
    _put(spark, f"{root}/meta/modality.json", json.dumps(modality, indent=2, sort_keys=True))
    for name, rows in (("episodes", episodes), ("tasks", tasks)):
        rewrite(rows, f"{root}/meta/{name}", "json")
    return info


def save_table(table: DataFrame, path: str, mode: str = "overwrite") -> None:
    w = table.write.mode(mode)
    w.csv(path, header=True) if path.rstrip("/").endswith(".csv") else w.parquet(path)


def append_jsonl(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def rewrite(table: DataFrame, path: str, kind: str = "parquet") -> None:
    """Replaces a stored table that the plan of `table` may read: written beside it, then swapped. The old table is moved aside first
    and comes back if the new one can't take its place, so that a failure loses neither."""
    spark = table.sparkSession
    table.write.format(kind).save(new := f"{path}.{uuid.uuid4().hex}.tmp")
    p = spark._jvm.org.apache.hadoop.fs.Path
    fs = p(path).getFileSystem(spark._jsc.hadoopConfiguration())
    old = None
    if fs.exists(p(path)):
        old = f"{path}.{uuid.uuid4().hex}.old"
        if not fs.rename(p(path), p(old)):
            raise OSError(f"{path} can't be moved aside")
    if not fs.rename(p(new), p(path)):
        if old and not fs.rename(p(old), p(path)):
            raise OSError(f"{path} can't be written; the former table is at {old}")
        raise OSError(f"{path} can't be written")
    if old:
        fs.delete(p(old), True)


def write_date_views(frames: DataFrame, episodes: DataFrame, root: str) -> DataFrame:
    """Frames by source date (undated episodes are left out) and the totals of each date."""
    dated = episodes.where("source_date IS NOT NULL").select(F.col("episode_index").alias("__e"), "source_date")
    frames.join(dated, F.col("episode_index") == F.col("__e")).drop("__e").write.mode("overwrite").partitionBy("source_date").parquet(f"{root}/by_date")
    return date_view(episodes)


def write_manifest(new: DataFrame, path: str) -> None:
    """Refreshed kinds of items replace those in the stored manifest."""
    from motionloom.sources.logs import _exists

    spark = new.sparkSession
    rewrite(merge_manifest(spark.read.parquet(path), new) if _exists(spark, path) else new, path)


def report_payload(summary: dict, **tables: DataFrame) -> str:
    """JSON of a report: a summary and bounded tables (top-k and per-date rows), NaN as null."""
    from motionloom.operators.rules import json_safe

    rows = {k: [json.loads(r) for r in json_safe(t).toJSON().collect()] for k, t in tables.items()}
    return json.dumps({"summary": summary, **rows}, sort_keys=True)


def html_report(title: str, payload: str) -> str:
    """A page that shows the tables of a payload."""
    data = json.loads(payload)
    parts = [f"<h1>{title}</h1>", "<pre>" + json.dumps(data.pop("summary"), indent=1) + "</pre>"]
    for name, rows in data.items():
        cols = list(dict.fromkeys(k for r in rows for k in r))
        cell = lambda x: str("" if x is None else x).replace("&", "&amp;").replace("<", "&lt;")
        parts.append(f"<h2>{name}</h2><table><tr>" + "".join(f"<th>{cell(c)}</th>" for c in cols) + "</tr>" + "".join("<tr>" + "".join(f"<td>{cell(r.get(c))}</td>" for c in cols) + "</tr>" for r in rows) + "</table>")
    return "<!DOCTYPE html><html><head><meta charset='utf-8'></head><body>" + "".join(parts) + "</body></html>"
