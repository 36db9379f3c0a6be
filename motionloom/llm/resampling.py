"""Importance resampling towards a target: hashed n-gram gains and Gumbel noise, the highest scores are drawn.

Counting: a task splits its texts into words, numbers a run's distinct words and n-grams (whole numbers stand for strings), and
sends each distinct word and triple with its count to a part of the dictionary, as sorted compressed text. Words are dealt by
their hash and triples by that of their first two words, with the pairs that end a text as triples without a third; so a
part holds all triples of its pairs, and pairs, which would be nearly half of the strings, need not be sent. A part puts the
counts of equal strings together, hashes each distinct string once, and returns counts per bucket; so does the target. A
frequent string leaves each run once, and a frequent pair as many times as it has followers there.

Scoring: bucket gains (a row per bucket, the only thing that is broadcast) go back to the features of the documents. The join
is on the bucket: a run hashes each of its distinct words, and the hash of an n-gram follows from those of its words, since
CRC-32 is linear. To send every run the answers of the dictionary instead would move two more bytes for each of its
distinct strings, which is about the size of the input (README).

Drawing: scores are numbered in one order by ranges; there is no sort in one task.

Defined results: null and empty texts have no words, no features and weight 0. A null id takes the noise of the empty id, and
comes last among equal scores. Repeated rows are documents of their own, with equal scores and ranks of their own. An
empty table gives an empty result; an empty target has no counts. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionloom.llm.common import cut, release, small_batches, table, text_slices
from motionloom.llm.words import words_of
from motionloom.operators.ranks import in_order

N, BUCKETS = 3, 10_000
SLICE_BYTES = 8 << 20
#: Words of a run; its cube fits in 63 bits, so that a whole number stands for any n-gram of a run.
RUN_WORDS = 1_500_000
#: Bytes of text for each part of the dictionary, about a million distinct n-grams.
PART_BYTES, LEAST_PARTS = 4 << 20, 24
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Run:
    """The n-grams that start at up to RUN_WORDS consecutive words. owner: the document of each word."""

    def __init__(self, words: pa.Array, owner: np.ndarray, starts: int):
        coded = words.dictionary_encode()
        order = pc.sort_indices(coded.dictionary)
        self.words = coded.dictionary.take(order)
        place = np.empty(len(order), np.int64)
        place[order.to_numpy()] = np.arange(len(order))
        self.codes = place[coded.indices.to_numpy()]
        self.owner, self.starts = owner, starts

    def triples(self) -> list[np.ndarray]:
        """The distinct pairs with their followers: codes of three words (len(words) for a third word past the text's end), and counts."""
        base, last = len(self.words) + 1, min(self.starts, len(self.codes) - 1)
        if last <= 0:
            return [np.zeros(0, np.int64)] * 4
        third = np.full(last, base - 1, np.int64)
        more = min(last, len(self.codes) - 2)
        third[:more] = np.where(self.owner[:more] == self.owner[2 : more + 2], self.codes[2 : more + 2], base - 1)
        inside = self.owner[:last] == self.owner[1 : last + 1]
        keys, counts = np.unique(((self.codes[:last] * base + self.codes[1 : last + 1]) * base + third)[inside], return_counts=True)
        return [keys // base // base, keys // base % base, keys % base, counts]


def joined(*columns: pa.Array, by: bytes) -> pa.Array:
    return pc.binary_join_element_wise(*columns, pa.scalar(by, pa.large_binary()))


def packed(strings: pa.Array, counts: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, list[bytes], list[bytes]]:
    """(parts, their strings with an end of line each, their counts), compressed; in a part the order stays."""
    press = zstandard.ZstdCompressor(level=3)
    order = np.argsort(part, kind="stable")
    lines = joined(strings.take(pa.array(order)), pa.array([b""] * len(order), pa.large_binary()), by=b"\n")
    counts, part = counts[order], part[order]
    at, data = np.frombuffer(lines.buffers()[1], np.int64)[: len(lines) + 1], memoryview(lines.buffers()[2] or b"")
    some = np.unique(part)
    ends = np.append(np.searchsorted(part, some), len(part))
    cuts = list(zip(ends[:-1], ends[1:], strict=True))
    return some, [press.compress(data[at[a] : at[z]]) for a, z in cuts], [press.compress(counts[a:z].tobytes()) for a, z in cuts]


def unpacked(blobs: list[bytes], times: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The distinct strings of all blobs, with their ends of line, and the sums of their counts."""
    unpack, pieces = zstandard.ZstdDecompressor(), []
    for blob in blobs:
        data = unpack.decompress(blob)
        ends = np.flatnonzero(np.frombuffer(data, np.uint8) == ord("\n")) + 1
        pieces.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)), pa.py_buffer(data)]))
    if not pieces:
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64)
    entries = pa.concat_arrays(pieces).dictionary_encode()
    total = np.zeros(len(entries.dictionary), np.int64)
    np.add.at(total, entries.indices.to_numpy(), np.concatenate([np.frombuffer(unpack.decompress(t), np.int64) for t in times]))
    return entries.dictionary, total


def bounds(strings: pa.Array) -> tuple[np.ndarray, bytes]:
    """Where each string begins in the bytes of all, and where the last one ends; those bytes."""
    if not len(strings):
        return np.zeros(1, np.int64), b""
    at = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
    return at, (strings.buffers()[2] or pa.py_buffer(b"")).to_pybytes()


def hashes(strings: pa.Array, end: int) -> np.ndarray:
    """CRC-32 of each string without its last `end` bytes."""
    at, data = bounds(strings)
    return np.fromiter(map(zlib.crc32, [data[s:e] for s, e in zip(at[:-1].tolist(), (at[1:] - end).tolist(), strict=True)]), np.int64, len(strings))


def first_two(triples: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Of strings of three words with an end of line: the first two words, and whether the third is empty."""
    at, data = bounds(triples)
    second = np.flatnonzero(np.frombuffer(data, np.uint8)[at[0] : at[-1]] == ord(" "))[1::2] + at[0]  # words hold no spaces
    cuts = np.empty(2 * len(triples) + 1, np.int64)
    cuts[::2], cuts[1::2] = at, second
    halves = pa.LargeBinaryArray.from_buffers(pa.large_binary(), 2 * len(triples), [None, pa.py_buffer(cuts), pa.py_buffer(data)])
    return halves.take(pa.array(np.arange(0, len(halves), 2))), at[1:] - second == 2


def _zeros(basis: tuple[int, ...], times: int) -> tuple[int, ...]:
    """basis: what a linear map makes of each of 32 bits -> the same of the map applied so often."""
    out, power = tuple(1 << i for i in range(32)), basis
    through = lambda f, x: functools.reduce(lambda acc, i: acc ^ f[i], (i for i in range(32) if x >> i & 1), 0)
    while times:
        if times & 1:
            out = tuple(through(power, x) for x in out)
        power, times = tuple(through(power, x) for x in power), times >> 1
    return out


#: What one more zero byte makes of each bit of a CRC-32.
_ONE_ZERO = tuple(zlib.crc32(b"\0", (1 << i) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF ^ (zlib.crc32(b"\0", 0xFFFFFFFF) ^ 0xFFFFFFFF) for i in range(32))


@functools.lru_cache(maxsize=4096)
def _shift_table(length: int) -> np.ndarray:
    """4 x 256: the map of `length` zero bytes, by byte of its argument."""
    basis = np.array(_zeros(_ONE_ZERO, length), np.uint32)
    bits = (np.arange(256)[:, None] >> np.arange(8)) & 1 > 0
    return np.stack([np.bitwise_xor.reduce(np.where(bits, basis[8 * k : 8 * k + 8], np.uint32(0)), axis=1) for k in range(4)])


def crc_of_joined(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of strings joined in pairs, from those of their parts; length: of the second part."""
    lengths, which = np.unique(length, return_inverse=True)
    tables = np.concatenate([_shift_table(int(n)).ravel() for n in lengths]) if len(lengths) else np.zeros(0, np.uint32)
    at = which.astype(np.int64) * 1024
    out = second.copy()
    for k in range(4):
        out ^= tables[at + 256 * k + ((first >> np.uint32(8 * k)) & np.uint32(255))]
    return out


def runs(texts: pa.Array) -> Iterator[Run]:
    words, counts = words_of(texts)
    owner = np.repeat(np.arange(len(counts)), counts)
    for at in range(0, len(words), RUN_WORDS):
        to = min(len(words), at + RUN_WORDS + N - 1)
        yield Run(words[at:to], owner[at:to], min(RUN_WORDS, len(words) - at))


def feature_counts(words: np.ndarray) -> np.ndarray:
    return sum(np.maximum(words - k, 0) for k in range(N))


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many of the features of all texts fall into each bucket, by a dictionary of all distinct strings."""
    text = F.col(f"`{text_col}`")
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    parts = max(LEAST_PARTS, size // PART_BYTES)

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deal = lambda h: (h >> np.uint64(32)).astype(np.int64) % parts
        for batch in text_slices(batches, SLICE_BYTES):
            for run in runs(batch.column("text")):
                crc = np.fromiter(map(zlib.crc32, run.words.to_pylist()), np.uint64, len(run.words)) * _MIX
                one, own = np.unique(run.codes[: run.starts], return_counts=True)
                first, second, third, times = run.triples()
                column = lambda c: run.words.take(pa.array(c))  # noqa: B023, E731
                follower = pa.concat_arrays([run.words, pa.array([b""], pa.large_binary())]).take(pa.array(third))
                for n, (part, strings, counts) in ((1, packed(column(one), own, deal(crc[one]))), (3, packed(joined(column(first), column(second), follower, by=b" "), times, deal((crc[first] ^ (crc[second] >> np.uint64(7))) * _MIX)))):
                    yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(np.full(len(part), n)), pa.array(strings, pa.binary()), pa.array(counts, pa.binary())], names=["part", "n", "strings", "counts"])

    def together(key: tuple, got: pa.Table) -> pa.Table:
        of = lambda n: unpacked(*[got.filter(pc.equal(got.column("n"), n)).column(c).to_pylist() for c in ("strings", "counts")])
        words, own = of(1)
        triples, times = of(3)
        pairs, ended = first_two(triples)
        pairs = pairs.dictionary_encode()
        both = np.zeros(len(pairs.dictionary), np.int64)
        np.add.at(both, pairs.indices.to_numpy(), times)
        sums = np.zeros(buckets, np.int64)
        for strings, end, counts in ((words, 1, own), (pairs.dictionary, 0, both), (triples, 1, np.where(ended, 0, times))):
            np.add.at(sums, hashes(strings, end) % buckets, counts)
        some = np.flatnonzero(sums)
        return pa.table({"bucket": pa.array(some, pa.int64()), "n": pa.array(sums[some], pa.int64())})

    sent = docs.select(text.alias("text")).mapInArrow(distinct, "part bigint, n bigint, strings binary, counts binary")
    sums = sent.groupBy("part").applyInArrow(together, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # a row per bucket
    release(docs.sparkSession)
    out = np.zeros(buckets, np.int64)
    out[sums.column("bucket").to_numpy()] = sums.column("n").to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's gain: how much likelier it is in the target, in thousandths of the logarithm, with one more count each."""
    k, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + k) / ((s + 1.0) * (t_all + k)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weights(docs: DataFrame, by_bucket: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, words, n_features, weight: one row per input row."""
    shared = docs.sparkSession.sparkContext.broadcast(by_bucket)

    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for b in text_slices(batches, SLICE_BYTES):
            words, counts = words_of(b.column("text"))
            coded = words.dictionary_encode()
            code, strings = coded.indices.to_numpy(), coded.dictionary.to_pylist()
            crc, spaced = (np.fromiter(map(zlib.crc32, x), np.uint32, len(strings))[code] for x in (strings, [s + b" " for s in strings]))
            length = np.fromiter(map(len, strings), np.int64, len(strings))[code]
            # of the grams that start at a word: its own hash, and that of its words with a space after
            own, with_space, ends = crc, spaced, np.cumsum(counts)
            weight = np.zeros(len(counts), np.int64)
            for n in range(1, N + 1):
                so_far = np.concatenate([[0], np.cumsum(gain[own.astype(np.int64) % len(gain)])])
                last = np.maximum(ends - n + 1, ends - counts)  # past the last start in each text
                weight += so_far[np.minimum(last, len(own))] - so_far[np.minimum(ends - counts, len(own))]
                if n < N:
                    left = max(0, len(words) - n)
                    own, with_space = crc_of_joined(with_space[:left], crc[n:], length[n:]), crc_of_joined(with_space[:left], spaced[n:], length[n:] + 1)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(counts.astype(np.int64)), pa.array(feature_counts(counts.astype(np.int64))), pa.array(weight)], names=["id", "words", "n_features", "weight"])

    src = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return src.mapInArrow(run_all, "id bigint, words bigint, n_features bigint, weight bigint")


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """id_col, n_features, weight, score, rank: one row per input row; rank from 1 for those drawn, else null.

    Of the documents with at least least_words words, percent in a hundred (rounded down) are drawn: the highest scores, which
    is a draw without replacement in proportion to exp(weight / 1000); ties go to the smaller id."""
    with small_batches(docs.sparkSession):
        by_bucket = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_col, buckets))
        found = cut(weights(docs, by_bucket, id_col, text_col))
    noise = (F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    rows = found.withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log(noise))).cast("bigint")).withColumn("may", F.col("words") >= least_words)
    placed = in_order(rows, F.desc("may"), F.desc("score"), F.col("id").asc_nulls_last())
    drawn = (placed.where("may").count() * percent) // 100
    return placed.select(F.col("id").alias(id_col), "n_features", "weight", "score", F.when(F.col("number") < drawn, F.col("number") + 1).alias("rank"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
