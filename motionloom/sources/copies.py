"""Copies of datasets in any file system that Spark reaches, in parallel and restartable, and their arrangement by date."""

from __future__ import annotations

import datetime
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionloom.sources.logs import _exists

#: Bytes that a task holds of a file while it copies it.
BLOCK = 8 << 20
_COPIED = "file string, bytes bigint, action string"


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _full(spark: SparkSession, path: str) -> str:
    fs, where = _fs(spark, path)
    return fs.makeQualified(where).toString().rstrip("/")


def files_below(spark: SparkSession, root: str) -> DataFrame:
    """file (below root), bytes, of every file but backups (.bak_ in the name) and unfinished ones (.tmp at the end). The
    listing passes through the driver: a name and a size per file, nothing of the content."""
    base = _full(spark, root)
    fs, where = _fs(spark, base)
    found, rows = fs.listFiles(where, True), []
    while found.hasNext():
        status = found.next()
        path = status.getPath().toString()[len(base) + 1:]
        if not any(".bak_" in p or p.endswith(".tmp") for p in path.split("/")):
            rows.append((path, status.getLen()))
    return spark.createDataFrame(rows, "file string, bytes bigint")


def _copier(source: str, target: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os
        import uuid

        from pyarrow import fs as A

        def opened(uri: str):
            return (A.LocalFileSystem(), "/" + uri.split(":", 1)[1].lstrip("/")) if uri.startswith("file:") else A.FileSystem.from_uri(uri)

        (src, a), (dst, b) = opened(source), opened(target)
        for pdf in batches:
            rows = []
            for name, size in zip(pdf["file"], pdf["bytes"], strict=True):
                info = dst.get_file_info(f"{b}/{name}")
                if info.type == A.FileType.File and info.size == size:
                    rows.append((name, size, "kept"))
                    continue
                dst.create_dir(os.path.dirname(f"{b}/{name}"), recursive=True)
                part = f"{b}/{name}.{uuid.uuid4().hex}.tmp"
                with src.open_input_stream(f"{a}/{name}", compression=None) as i, dst.open_output_stream(part, compression=None) as o:
                    while block := i.read(BLOCK):
                        o.write(block)
                dst.move(part, f"{b}/{name}")
                rows.append((name, size, "copied"))
            yield pd.DataFrame(rows, columns=["file", "bytes", "action"])

    return run


def copy_dataset(spark: SparkSession, source: str, target: str, overwrite: bool = False, tasks: int | None = None) -> dict[str, int]:
    """Copies all files but backups and unfinished ones; files copied and kept, and bytes copied.

    Each file appears whole, by a rename. An unfinished copy says so in a file of its own until its last file is there: calling
    again then copies only what is missing, so lost executors and a lost driver cost repeated files only. A target that is
    whole raises FileExistsError, unless overwrite, which deletes it first."""
    src, dst = _full(spark, source), _full(spark, target)
    if not _exists(spark, src):
        raise FileNotFoundError(source)
    if src == dst or dst.startswith(src + "/") or src.startswith(dst + "/"):
        raise ValueError("source and target must lie apart")
    mark = dst + ".unfinished"
    fs, where = _fs(spark, dst)
    _, flag = _fs(spark, mark)
    if fs.exists(where) and not fs.exists(flag):
        if not overwrite:
            raise FileExistsError(target)
        fs.delete(where, True)  # before the mark: files of an old copy must not pass for files of this one
    fs.create(flag, True).close()
    fs.mkdirs(where)
    files = files_below(spark, src).repartition(tasks or spark.sparkContext.defaultParallelism, "file")
    done = files.mapInPandas(_copier(src, dst), _COPIED).groupBy("action").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).collect()
    fs.delete(flag, False)
    by = {r["action"]: r for r in done}
    return {"copied": by["copied"]["n"] if "copied" in by else 0, "kept": by["kept"]["n"] if "kept" in by else 0, "bytes": by["copied"]["bytes"] if "copied" in by else 0}


def created_at(spark: SparkSession, path: str) -> datetime.datetime:
    """When path came to be, as far as its file system says: the time of its modification, in local time with an offset.
    Hadoop's file systems keep no time of birth; of a local path that is taken where the system has it, else that of the last
    change of its entry."""
    full = _full(spark, path)
    if full.startswith("file:"):
        import os

        s = os.stat(full[len("file:"):].replace("//", "/", 1) if full.startswith("file:///") else full[len("file:"):])
        stamp = getattr(s, "st_birthtime", 0) or s.st_ctime or s.st_mtime
    else:
        fs, where = _fs(spark, full)
        stamp = fs.getFileStatus(where).getModificationTime() / 1000
    return datetime.datetime.fromtimestamp(stamp).astimezone()


def arrange(spark: SparkSession, sources: Sequence[str], item_type: str, root: str, mode: str = "reference") -> DataFrame:
    """item_type, name, date, source_path, link_path, created_at, mode: each source below root/<date of its creation>/<name>.

    copy copies it (again, where a copy is there). reference writes nothing but the row: object stores have no links, and a
    reader follows source_path. Sources that are absent have no row; two of one name and date raise ValueError."""
    if mode not in ("reference", "copy"):
        raise ValueError(f"no mode {mode}")
    rows = []
    for s in sources:
        if not _exists(spark, s):
            continue
        made, name = created_at(spark, s), s.rstrip("/").rsplit("/", 1)[-1]
        date = made.strftime("%Y-%m-%d")
        rows.append((item_type, name, date, _full(spark, s), f"{root.rstrip('/')}/{date}/{name}", made.isoformat(), mode))
    places = [r[4] for r in rows]
    if len(set(places)) < len(places):
        raise ValueError(f"several sources would share a place: {sorted(p for p in set(places) if places.count(p) > 1)}")
    for r in rows if mode == "copy" else ():
        copy_dataset(spark, r[3], r[4], overwrite=True)
    return spark.createDataFrame(rows, "item_type string, name string, date string, source_path string, link_path string, created_at string, mode string")
