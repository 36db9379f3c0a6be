"""Exact top-k by integer inner product, a block at a time.

Vectors are documents, dimensions are terms, and floor(64 x) are the weights. Candidates lie in document-range blocks (runs
of ascending ids), each with a forward index (its vectors) and the largest and smallest weight of every term. A query's
bound on a block is the sum over terms of its weight times that maximum (minimum where its weight is negative). Each query
takes the blocks in falling order of bound and stops when the next bound is below its k-th score, so nothing is missed.

Distribution: candidates are dealt into shards and queries into groups, both of bounded size; each pair of a group and a
shard is one task's work, and gives k rows per query. Per query, k rows of each shard meet in the end.

Defined results: vectors that are null or hold null or non-finite components, and rows without id, take no part. Vectors
of fewer dimensions are padded with zeros. The query's own id is no candidate, whichever row holds it. Rows that repeat a
query's id and vector are one query; candidates that repeat an id are listed as often as they occur. Scores must fit 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from motionloom.llm.common import table

BLOCK, SHARD_VALUES, GROUP_VALUES = 256, 1 << 20, 1 << 17


def search(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, c: np.ndarray, k: int, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Integer rows q and c -> (row of q, candidate id, score) of each query's k best, ties to smaller ids."""
    order = np.argsort(ids, kind="stable")
    ids, c = ids[order], c[order]
    most = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(c.astype(np.float64)).max(initial=0)) * max(1, q.shape[1])
    if most >= 2**63:
        raise ValueError("scores may not fit in 64 bits")
    if most < 2**53:
        q, c = q.astype(np.float64), c.astype(np.float64)  # exact, and much faster
    starts = np.arange(0, len(ids), block)
    top, low = np.maximum.reduceat(c, starts), np.minimum.reduceat(c, starts)
    bounds = np.maximum(q, 0) @ top.T + np.minimum(q, 0) @ low.T
    visits = np.argsort(-bounds, axis=1, kind="stable")
    none = np.iinfo(np.int64).min if q.dtype == np.int64 else -np.inf
    best, who = np.full((len(q), k), none, q.dtype), np.full((len(q), k), np.iinfo(np.int64).max)
    filled = np.zeros(len(q), np.int64)
    going = np.arange(len(q))
    for r in range(len(starts)):
        own = visits[going, r]
        more = (filled[going] < k) | (bounds[going, own] >= best[going, k - 1])  # an equal score may have a smaller id
        going, own = going[more], own[more]
        if not len(going):
            break
        by_block = np.argsort(own, kind="stable")
        for part in np.split(by_block, np.flatnonzero(np.diff(own[by_block])) + 1):
            rows, s = going[part], starts[own[part[0]]]
            near = ids[s : s + block]
            score = q[rows] @ c[s : s + block].T
            other = near[None, :] != q_ids[rows, None]
            score = np.where(other, score, none)
            hit = (filled[rows] < k) | (score.max(axis=1) >= best[rows, k - 1])
            rows, score, other = rows[hit], score[hit], other[hit]
            if not len(rows):
                continue
            all_s = np.concatenate([best[rows], score], axis=1)
            all_i = np.concatenate([who[rows], np.where(other, near[None, :], np.iinfo(np.int64).max)], axis=1)
            pick = np.lexsort((all_i, -all_s), axis=-1)[:, :k] if q.dtype != np.int64 else np.lexsort((all_i, ~all_s), axis=-1)[:, :k]
            best[rows], who[rows] = np.take_along_axis(all_s, pick, 1), np.take_along_axis(all_i, pick, 1)
            filled[rows] = np.minimum(k, filled[rows] + other.sum(axis=1))
    found = np.arange(k)[None, :] < filled[:, None]
    at = np.nonzero(found)[0]
    return at, who[found], best[found].astype(np.int64)


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """id, dims, v (binary: 64-bit integers), without the vectors that take no part. A finite component that does not fit in
    64 bits once scaled stops the query: it has no right score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column("v")
            dims = np.diff(col.offsets.to_numpy())
            values = col.flatten()
            x = values.cast(pa.float64()).to_numpy(zero_copy_only=False)
            fine = np.isfinite(x)
            ends = np.concatenate(([0], np.cumsum(fine)))
            at = np.concatenate(([0], np.cumsum(dims)))
            ok = ends[at[1:]] - ends[at[:-1]] == dims
            scaled = np.floor(np.where(fine, x, 0) * scale)
            if len(scaled) and float(np.abs(scaled).max()) >= 2.0**63:
                raise ValueError("a scaled component does not fit in 64 bits")
            ints = scaled.astype("<i8")
            rows = np.flatnonzero(ok)
            yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(rows)), pa.array(dims[rows], pa.int32()), pa.array([ints[at[i] : at[i + 1]].tobytes() for i in rows], pa.binary())], names=["id", "dims", "v"])

    src = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{vector_col}`").alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    return src.mapInArrow(run, "id bigint, dims int, v binary")


def _matrix(rows: pa.Table, dims: int) -> np.ndarray:
    out = np.zeros((rows.num_rows, dims), np.int64)
    for i, x in enumerate(rows.column("v").to_pylist()):
        own = np.frombuffer(x, "<i8")
        out[i, : len(own)] = own
    return out


def top_k(rows: DataFrame, is_query, k: int = 20) -> DataFrame:
    """rows: as from quantised(); is_query: condition on id. Returns query_id, rank, vec_id, score."""
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max("dims"), F.lit(0)).alias("dims"), F.count_if(is_query).alias("queries")).first()
    dims = max(1, size["dims"])
    shards, groups = math.ceil(max(1, size["n"]) * dims / SHARD_VALUES), math.ceil(max(1, size["queries"]) * dims / GROUP_VALUES)
    spot = F.xxhash64("id", "v")
    cands = rows.withColumn("s", F.pmod(spot, F.lit(shards)).cast("int")).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asks = rows.where(is_query).dropDuplicates(["id", "v"]).withColumn("g", F.pmod(spot, F.lit(groups)).cast("int")).withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def meet(asked: pa.Table, held: pa.Table) -> pa.Table:
        if asked.num_rows and held.num_rows:
            q_ids = asked.column("id").to_numpy()
            at, ids, scores = search(q_ids, _matrix(asked, dims), held.column("id").to_numpy(), _matrix(held, dims), k)
            keys = asked.column("key").to_numpy()[at]
            q_ids = q_ids[at]
        else:
            q_ids = keys = ids = scores = np.zeros(0, np.int64)
        return pa.table({"query_id": q_ids, "key": keys, "vec_id": ids, "score": scores})

    near = asks.withColumn("key", F.xxhash64("v")).groupBy("g", "s").cogroup(cands.groupBy("g", "s")).applyInArrow(meet, "query_id bigint, key bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(quantised(table(spark, sf_dir, "embeddings")), F.col("id") % 20 == 0)


SQL = """
WITH t AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM t q JOIN t c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
