"""Connected components of a link table, distributed: forests of blocks of links, and alternating large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motionloom.llm.common import Scratch, apart, cut, lean, release

#: Links of a block, which one task turns into a forest.
BLOCK = 500_000


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One round. links: a > b, distinct. The smallest neighbour is a map-side aggregate; the join back splits hot nodes.
    It is a merge join by hint, since the broadcasts of many rounds would pile up in the driver."""
    if large:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m")).hint("merge")
        new = both.where("b > a").join(low, apart(F.col("a")) == apart(F.col("u"))).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        low = links.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        new = links.join(low.hint("merge"), apart(F.col("a")) == apart(F.col("u"))).select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return new.where("a > b").groupBy("a", "b").agg(F.lit(1).alias("one")).select("a", "b")


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links a, b of a task -> those of each node with the smallest one that it reaches in a block of links, fewer or as many."""

    def roots(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        nodes, at = np.unique(np.concatenate([x.column(c).to_numpy() for c in ("a", "b") for x in held]), return_inverse=True)
        root = local_roots(len(nodes), *np.split(at, 2))
        moved = np.flatnonzero(root != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[root[moved]])], names=["a", "b"])

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n > 2 * BLOCK:
            yield roots(held)
            held, n = [], 0
    if n:
        yield roots(held)


def connected_components(links: DataFrame) -> DataFrame:
    """links: a, b (bigint, any order, repeats allowed, nulls ignored). Returns node, root for every node but the roots
    themselves; root is the smallest node reachable. An empty table gives an empty result.

    Each round is a written table; the driver sees a count and a checksum only. What fits one block needs no round."""
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    with Scratch(links.sparkSession, "components") as tables:
        links = tables.keep(links.groupBy("a", "b").agg(F.lit(1).alias("one")).select("a", "b"))
        before = _state(links)
        while before[0]:
            blocks = -(-before[0] // BLOCK)
            forest = links.coalesce(blocks).mapInArrow(lean(_forest), "a bigint, b bigint")
            if blocks == 1:
                return cut(forest.select(F.col("a").alias("node"), F.col("b").alias("root")))
            links = tables.keep(_star(_star(tables.keep(forest.distinct()), large=True), large=False))
            after = _state(links)
            if after == before:
                break
            before = after
            release(links.sparkSession)
        return cut(links.select(F.col("a").alias("node"), F.col("b").alias("root")))


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and links a[i]-b[i]: the smallest node reachable from each."""
    root = np.arange(n)
    while True:
        ra, rb = root[a], root[b]
        if not (ra != rb).any():
            return root
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while ((up := root[root]) != root).any():
            root = up
