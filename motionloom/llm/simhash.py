"""SimHash near-duplicates: all links within 3 bits, found by hashing balls that meet in the middle.

Fingerprint: 64 bits, majority vote of XXH64 (seed 42) over the word shingles of the text, repeats included.

Links: radius 3 has no whole half, so the halves are dealt by parity. A fingerprint with an even number of set bits
emits its 64 variants at distance 1, one with an odd number emits itself and its 2016 variants at distance 2; any two
fingerprints within 3 bits then share a variant (even-even at 1+1, odd-odd at 0+2, even-odd at 1+0 or 1+2), and two that
share one are linked unless both sit at distance 2 from it. A variant's group therefore needs a star around one member,
never all pairs.

Shuffle: variants are dealt by the Hamming syndrome of their bits (bit i adds i), so a bucket's variants follow from the
fingerprints alone: each map task sends packed fingerprints to the 64 syndromes (times 2^k slices, k from the number of
distinct fingerprints, so that a bucket's variants fit in memory), and the bucket regenerates its own variants. Each
bucket returns a forest over what it linked; components over distinct fingerprints follow by distributed star rounds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionloom.llm import jaccard
from motionloom.llm.common import apart, as_bytes, cut, keep_one, lean, lean_groups, numbered, release, small_batches, table, text_slices
from motionloom.llm.components import connected_components, local_roots

RADIUS = 3
BUCKET_VARIANTS = 4_000_000
ONE = np.uint64(1)


def fingerprint(text: bytes, words_per_shingle: int = 3, step: int = 65_280) -> int:
    """Unsigned 64 bits; 0 for a text without words. Works through the shingles in steps of bounded memory."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    k = min(words_per_shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - k + 1].tolist()
    ends = ends[k - 1 :].tolist()
    counts, digest, n = np.zeros(64, np.int64), xxhash.xxh64_digest, len(starts)
    for at in range(0, n, step):
        raw = np.frombuffer(b"".join([digest(joined[s:e], 42) for s, e in zip(starts[at : at + step], ends[at : at + step], strict=True)]), np.uint8)
        bits = np.unpackbits(raw).reshape(-1, 64)
        whole = len(bits) // 255 * 255
        if whole:
            counts += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        counts += bits[whole:].sum(axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3) -> DataFrame:
    """id, fp (the fingerprint's bits as a signed bigint), one row per input row. Null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, 8 << 20):
            fps = np.array([fingerprint(t, words_per_shingle) for t in as_bytes(b.column("text"))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(fps)], names=["id", "fp"])

    src = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return src.mapInArrow(lean(run), "id bigint, fp bigint")


def _syndromes(fps: np.ndarray) -> np.ndarray:
    """XOR of the numbers of the set bits: 6 bits."""
    out = np.zeros(len(fps), np.int64)
    for bit, places in enumerate((0xAAAAAAAAAAAAAAAA, 0xCCCCCCCCCCCCCCCC, 0xF0F0F0F0F0F0F0F0, 0xFF00FF00FF00FF00, 0xFFFF0000FFFF0000, 0xFFFFFFFF00000000)):
        out |= (np.bitwise_count(fps & np.uint64(places)).astype(np.int64) & 1) << bit
    return out


#: For each d from 1 to 63, the 32 pairs of bits whose numbers differ by XOR d.
PAIRS = np.zeros((64, 32), np.uint64)
for _d in range(1, 64):
    PAIRS[_d] = [(1 << i) | (1 << (i ^ _d)) for i in range(64) if i < i ^ _d]


def _slice_of(variants: np.ndarray, k: int) -> np.ndarray:
    return ((variants * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - k)).astype(np.int64) if k else np.zeros(len(variants), np.int64)


def _variants(fps: np.ndarray, syndrome: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The variants that fps emit into a syndrome: values, owners, kinds (0 at distance 1, 1 the odd one itself, 2 at distance 2)."""
    odd = np.bitwise_count(fps) & 1 == 1
    diff = _syndromes(fps) ^ syndrome
    even, far, self_ = np.flatnonzero(~odd), np.flatnonzero(odd & (diff != 0)), np.flatnonzero(odd & (diff == 0))
    values = np.concatenate([fps[even] ^ (ONE << diff[even].astype(np.uint64)), fps[self_], (fps[far, None] ^ PAIRS[diff[far]]).ravel()])
    owners = np.concatenate([even, self_, np.repeat(far, 32)])
    kinds = np.concatenate([np.zeros(len(even), np.int64), np.ones(len(self_), np.int64), np.full(len(far) * 32, 2)])
    return values, owners, kinds


def bucket_links(fps: np.ndarray, bucket: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of one bucket -> (fingerprint, smallest fingerprint that it reaches here), for those that reach a smaller one."""
    fps = np.unique(fps)
    values, owners, kinds = _variants(fps, bucket & 63)
    if k:
        here = _slice_of(values, k) == bucket >> 6
        values, owners, kinds = values[here], owners[here], kinds[here]
    if len(values) < 2:
        return fps[:0], fps[:0]
    order = np.argsort(values)
    values = values[order]
    first = np.concatenate(([True], values[1:] != values[:-1]))
    shared = ~first
    shared[:-1] |= ~first[1:]
    order, first = order[shared], first[shared]
    if not len(order):
        return fps[:0], fps[:0]
    group, owners, kinds = np.cumsum(first) - 1, owners[order], kinds[order]
    hub = np.minimum.reduceat(kinds << 40 | owners, np.flatnonzero(first))[group]
    linked = hub >> 40 < 2
    a, b = owners[linked], (hub & ((1 << 40) - 1))[linked]
    true = (a != b) & (np.bitwise_count(fps[a] ^ fps[b]) <= RADIUS)
    a, b = a[true], b[true]
    by_value = np.argsort(np.argsort(fps.view(np.int64)))
    back = np.argsort(by_value)
    root = local_roots(len(fps), by_value[a], by_value[b])
    moved = np.flatnonzero(root != np.arange(len(fps)))
    return fps[back[moved]], fps[back[root[moved]]]


def links(distinct_fps: DataFrame, n: int | None = None) -> DataFrame:
    """fp (distinct, bigint) -> a, b: links that connect all fingerprints within 3 bits of each other, and no others."""
    n = distinct_fps.count() if n is None else n
    k = max(0, math.ceil(math.log2(max(1, n * 16.5 / BUCKET_VARIANTS))))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fps), 50_000):
                part = fps[at : at + 50_000]
                buckets, blobs = [], []
                for s in range(64):
                    if not k:
                        buckets.append(s)
                        blobs.append(part.tobytes())
                        continue
                    values, owners, _ = _variants(part, s)
                    where = np.unique(_slice_of(values, k) << 32 | owners)
                    cutp = np.flatnonzero(np.diff(where >> 32)) + 1
                    for x in np.split(where, cutp):
                        if len(x):
                            buckets.append(int(x[0] >> 32) << 6 | s)
                            blobs.append(part[x & 0xFFFFFFFF].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), pa.array(blobs, pa.binary())], names=["bucket", "fps"])

    def meet(key: tuple, rows: pa.Table) -> pa.Table:
        fps = np.frombuffer(b"".join(rows.column("fps").to_pylist()), np.uint64)
        a, b = bucket_links(fps, key[0].as_py(), k)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return distinct_fps.select("fp").mapInArrow(lean(deal), "bucket bigint, fps binary").groupBy("bucket").applyInArrow(lean_groups(meet), "a bigint, b bigint")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3) -> DataFrame:
    """id_col, fingerprint (16 hex digits), component_id, one row per input row.

    component_id: the smallest id reachable over links of 3 bits or fewer. Null and empty texts have fingerprint zero and
    are linked like any other. Rows without id take part; component_id is null where no row of the component has an id.
    Repeated rows repeat in the result; an empty table gives an empty result; other columns are ignored."""
    rows = cut(fingerprints(docs, id_col, text_col, words_per_shingle))
    distinct = cut(rows.groupBy("fp").agg(F.min("id").alias("low")))
    roots = connected_components(links(distinct))
    placed = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = placed.groupBy(F.col("root").alias("r")).agg(F.min("low").alias("component_id"))
    by_fp = placed.join(lowest, apart(F.col("root")) == apart(F.col("r"))).select(F.col("fp").alias("f"), "component_id")
    return rows.join(by_fp, F.col("fp") == F.col("f")).select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def ball_pairs(rows: DataFrame, text_col: str = "text", words_per_shingle: int = 5) -> DataFrame:
    """rows: node, text -> a, b (a < b, distinct): pairs that connect all rows whose fingerprints are within 3 bits."""
    placed = cut(fingerprints(rows, "node", text_col, words_per_shingle))
    first = cut(placed.groupBy("fp").agg(F.min("id").alias("low")))
    release(rows.sparkSession)
    same = placed.join(first.select(F.col("fp").alias("f"), "low"), apart(F.col("fp")) == apart(F.col("f"))).where("id <> low").select(F.col("low").alias("a"), F.col("id").alias("b"))
    at = lambda c: first.select(F.col("fp").alias(f"f{c}"), F.col("low").alias(f"l{c}"))
    near = links(first).join(at("a").hint("merge"), F.col("a") == F.col("fa")).join(at("b").hint("merge"), F.col("b") == F.col("fb"))
    return cut(same.union(near.select(F.least("la", "lb"), F.greatest("la", "lb"))).distinct())


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", balls_first: bool = True) -> DataFrame:
    """The rows of docs, all columns, that stay: of rows that pairs of a Jaccard similarity of 0.8 or more over five-word
    shingles connect, exactly one, chosen as in keep_one.

    The pairs come from the fingerprints' balls that meet in the middle, and are verified on the sets. A pair at 0.8 differs in
    about ten bits, which no ball of affordable size reaches (within 3 bits lie about a fifth of the pairs), so what they miss
    is completed by the prefix-filtered join of `jaccard`, which misses none and is verified alike. balls_first=False leaves
    the balls out; the result is the same. Null text counts as empty; texts without words are equal; rows
    without id take part and stay only where no other row of their group has an id; of repeated rows one stays. An empty
    table gives an empty result. Columns of any other names pass through."""
    rows, node = numbered(docs)
    texts = rows.select(F.col(f"`{node}`").alias("node"), F.col(f"`{text_col}`").alias("text"))
    with small_batches(docs.sparkSession):
        members = jaccard.near_members(texts, ball_pairs(texts) if balls_first else None)
        return keep_one(rows, node, members, id_col, text_col)


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))
