"""Packing into sequences of at most 4096 tokens by powers of two.

A document of n tokens is cut into pieces whose lengths are its binary digits, longest first: n // 4096 whole pieces, then
the powers of two of the rest. Pieces of equal length share a bucket, and each is a sequence of its own: no sequence
crosses documents, every length is a power of two, and there is no padding.

Numbers: sequences are numbered bucket by bucket, longest first. Within a bucket the order is by a hash of (document,
start) and then by these, so that slices of the hash space are numbered independently: a count per (length, slice) is
the only thing that meets in one place, and its size is fixed by the number of slices.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from motionloom.llm.bpe import WORD_BPE, bpe, vocabulary_path
from motionloom.llm.common import cut, give_back, small_batches, table, text_slices

LENGTH = 4096
SLICE_PIECES = 200_000


def binary_lengths(n: int, most: int = LENGTH) -> list[int]:
    """n as whole pieces of the largest length, then falling powers of two."""
    rest = n % most
    return [most] * (n // most) + [1 << b for b in range(most.bit_length() - 2, -1, -1) if rest >> b & 1]


def pieces(docs: DataFrame, path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", most: int = LENGTH, with_ids: bool = True, slice_bytes: int = 5 << 20) -> DataFrame:
    """id, start, length, ids_crc32, doc_tokens and, if asked for, ids (binary: little-endian unsigned 32-bit integers).

    One row per piece; every document has at least the end id, so null and empty texts give one piece of length 1."""
    if most & (most - 1):
        raise ValueError("the sequence length is not a power of two")
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = bpe(path, library=True)
        for b in text_slices(batches, slice_bytes):
            at, start, length, crc, total, out = [], [], [], [], [], []
            for i, ids in enumerate(tok.encode_slice([t or "" for t in b.column("text").to_pylist()])):
                ids += end
                n, s = len(ids) // 4, 0
                for k in binary_lengths(n, most):
                    part = ids[4 * s : 4 * (s + k)]
                    at.append(i)
                    start.append(s)
                    length.append(k)
                    crc.append(zlib.crc32(part))
                    total.append(n)
                    if with_ids:
                        out.append(part)
                    s += k
            cols = {"id": b.column("id").take(pa.array(at, pa.int64())), "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()), "doc_tokens": pa.array(total, pa.int64())}
            if with_ids:
                cols["ids"] = pa.array(out, pa.binary())
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))
            del cols, at, start, length, crc, total, out
        tok.forget()
        give_back()

    src = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return src.mapInArrow(run, "id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + ", ids binary" * with_ids)


def pack(docs: DataFrame, path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", most: int = LENGTH, with_ids: bool = True) -> DataFrame:
    """id_col, start, length, ids_crc32, doc_tokens, [ids,] sequence_id, offset: one row per piece, which is a sequence.

    Rows without id, and rows that repeat an id, are documents of their own: they get sequences like any other, and equal
    rows get neighbouring numbers. An empty table gives an empty result; other columns of the input are ignored."""
    with small_batches(docs.sparkSession):
        got = cut(pieces(docs, path, end_id, id_col, text_col, most, with_ids))
    slices = 1 << max(0, math.ceil(math.log2(max(1, got.count()) / SLICE_PIECES)))
    got = got.withColumn("slice", F.pmod(F.xxhash64("id", "start"), F.lit(slices)))
    sizes = got.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("n"))
    # at most 13 lengths x slices rows; whether they are broadcast is left to the planner, which knows their size
    before = sizes.select(F.col("length").alias("l"), F.col("slice").alias("s"), F.coalesce(F.sum("n").over(Window.orderBy(F.desc("length"), "slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "slice").orderBy("id", "start", "doc_tokens", "ids_crc32"))
    keep = ["start", "length", "ids_crc32", "doc_tokens", *(["ids"] * with_ids)]
    return got.withColumn("own", own).join(before, (F.col("length") == F.col("l")) & (F.col("slice") == F.col("s"))).select(F.col("id").alias(id_col), *keep, (F.col("before") + F.col("own") - 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary_path(WORD_BPE), with_ids=False)
