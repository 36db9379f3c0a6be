"""Embeddings of episodes: vectors from their JSON, two components by a Gram matrix that is summed where the rows are, statuses."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motionloom.plugins import KINDS, reduce_status

#: A wider vector is refused: the matrix of width x width numbers is solved on the driver.
MOST_WIDTH = 4096
LEAST_ROWS = 3


def vectors(rows: DataFrame, column: str, key: str = "episode_index") -> DataFrame:
    """key, v: the JSON lists of numbers in column. The first by key that can be read fixes the width; others are left out,
    as are null, empty and unreadable texts and lists with a null."""
    v = F.from_json(F.col(column), "array<double>")
    read = rows.select(F.col(key), v.alias("v")).where((F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull()))
    first = read.agg(F.min_by(F.size("v"), key).alias("width"))
    return read.join(F.broadcast(first), F.size("v") == F.col("width")).drop("width")


def gram(rows: DataFrame, width: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, sum, sum of outer products). A task adds up its own rows; the lines of the partial matrices then meet line by
    line, with a map side, so that no task holds more than one matrix and the driver gets one."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    schema = pa.schema([("line", pa.int32()), ("part", pa.list_(pa.float64()))])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width + 1))
        for b in batches:
            x = np.ones((b.num_rows, width + 1))
            x[:, :width] = np.asarray(b.column(0).flatten()).reshape(b.num_rows, width)
            total += x.T @ x
        if total[width, width]:
            yield pa.record_batch([pa.array(range(width + 1), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], schema=schema)

    parts = rows.select("v").mapInArrow(add, "line int, part array<double>")
    lines = parts.groupBy("line").agg(vector_to_array(Summarizer.sum(array_to_vector("part"))).alias("x")).collect()
    out = np.zeros((width + 1, width + 1))
    for r in lines:
        out[r["line"]] = r["x"]
    return int(out[width, width]), out[width, :width], out[:width, :width]


def components(rows: DataFrame, key: str = "episode_index") -> DataFrame | None:
    """key, x, y: the two principal components of vectors(); None under three rows. The largest loading of each is positive;
    of a vector of one number y is 0."""
    first = rows.select(F.size("v").alias("n")).first()
    if first is None:
        return None
    width = int(first["n"])
    if width > MOST_WIDTH:
        raise ValueError(f"vectors of {width} numbers are wider than {MOST_WIDTH}")
    n, total, products = gram(rows, width)
    if n < LEAST_ROWS:
        return None
    mean = total / n
    load = np.linalg.eigh(products / n - np.outer(mean, mean))[1][:, ::-1][:, :2]
    load = load * np.where(load[np.abs(load).argmax(axis=0), np.arange(load.shape[1])] < 0, -1, 1)
    if load.shape[1] < 2:
        load = np.hstack([load, np.zeros((width, 1))])

    def along(k: int):
        weights = F.array(*[F.lit(float(w)) for w in load[:, k]])
        return F.aggregate(F.zip_with("v", weights, lambda a, b: a * b), F.lit(float(-mean @ load[:, k])), lambda s, t: s + t)

    return rows.select(key, along(0).alias("x"), along(1).alias("y"))


def reduced(embedded: DataFrame, episodes: DataFrame, key: str = "episode_index", kinds: tuple[str, ...] = KINDS) -> tuple[DataFrame | None, dict[str, str]]:
    """(key, embedding_kind, reducer, x, y, source_date of every kind that has enough rows; status by kind and reducer).

    A kind without vectors is skipped:no_embeddings, one with fewer than three skipped:not_enough_points. The reducer here is
    pca; what became of tsne and umap, whose libraries may be absent, is in the status."""
    out, status = None, {}
    for kind in kinds:
        column = f"{kind}_embedding"
        own = vectors(embedded, column, key) if column in embedded.columns else None
        if own is None or own.isEmpty():
            status[kind] = "skipped:no_embeddings"
            continue
        found = components(own, key)
        if found is None:
            status[kind] = "skipped:not_enough_points"
            continue
        status |= {f"{kind}_pca": "ok", f"{kind}_tsne": reduce_status("tsne"), f"{kind}_umap": reduce_status("umap")}
        rows = found.select(key, F.lit(kind).alias("embedding_kind"), F.lit("pca").alias("reducer"), "x", "y")
        out = rows if out is None else out.unionByName(rows)
    return (None if out is None else with_dates(out, episodes, key)), status


def with_dates(rows: DataFrame, episodes: DataFrame, key: str = "episode_index", columns: Mapping[str, str] | None = None) -> DataFrame:
    """rows with source_date of their episode, null where it has none; every row stays."""
    dates = episodes.select(F.col(key).alias("__episode"), F.col((columns or {}).get("source_date", "source_date")).alias("source_date"))
    return rows.join(dates, F.col(key) == F.col("__episode"), "left").drop("__episode")
