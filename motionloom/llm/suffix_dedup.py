"""Repeated byte windows, found by a depth-limited radix sort of suffixes, and their removal.

Every suffix is ordered only through `depth` bytes, by passes of falling significance; a group of suffixes that are still
equal after the last pass is exactly a repeated window, and a suffix alone in its group after any pass leaves at once.

Pass 1, all suffixes: the digit is the smallest hash among the 64-byte strings of the window (a function of the window's
bytes, so equal windows share it). Neighbouring suffixes mostly share that digit, so it is kept as runs, one row for
about 70 suffixes. Runs whose digit occurs once leave. Pass 2: the digit is the content of the run (length and 128 bits of
hash). A run that occurs twice is repeated as a whole. What is left are runs whose digit is shared but whose content is
their own, about three suffixes in a hundred: their bytes, with one copy of the repeated contents of the same digit, are
dealt into buckets of bounded size and sorted for real, eight bytes a pass, by most significant digit first.

Hot groups: copies are counted by map-side aggregates and found again by joins that adaptive execution splits. A digit
with more than HOT_CONTENTS different contents (the edge of a passage that a third of all documents share) never meets in
one bucket: its suffixes are counted one by one by 128 bits of hash over all bytes of the window, pre-aggregated.

Defined results: null text is empty; documents shorter than depth lose nothing; matches never cross documents. Rows with
equal id and text are copies of each other and get the same result. An empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionloom.llm.common import apart, as_bytes, cut, lean, lean_groups, release, small_batches, table, text_slices
from motionloom.operators.ranks import free_name

DEPTH, GRAM = 200, 64
SECTION = 1 << 20
HOT_CONTENTS, BUCKET_BYTES = 5000, 2 << 20
u64 = np.uint64


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate((np.ones(1, u64), np.full(n, base, u64))))


class Hashes:
    """Two polynomial hashes of byte strings modulo 2^64, over random odd values of the bytes."""

    _tables: dict[int, list] = {}

    def __init__(self, raw: np.ndarray):
        n = len(raw)
        if self._tables.get("n", -1) < n:
            size = max(n, 1 << 16)
            rng = np.random.default_rng(2024)
            self._tables["n"] = size
            for k, base in enumerate((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)):
                values = rng.integers(0, 2**63, 256, dtype=np.int64).view(u64) | u64(1)
                self._tables[k] = (values, _powers(base, size), _powers(pow(base, -1, 2**64), size))
        self.sums = []
        for k in (0, 1):
            values, up, _ = self._tables[k]
            self.sums.append(np.concatenate((np.zeros(1, u64), np.cumsum(values[raw] * up[:n]))))

    def of(self, k: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[k][end] - self.sums[k][start]) * self._tables[k][2][start])

    def windows(self, k: int, width: int) -> np.ndarray:
        s = self.sums[k]
        n = len(s) - width
        return _mix((s[width:] - s[:n]) * self._tables[k][2][:n])


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> u64(31))
    x = x * u64(0xBF58476D1CE4E5B9)
    return x ^ (x >> u64(29))


def sliding_min(g: np.ndarray, width: int) -> np.ndarray:
    n = len(g)
    padded = np.full(-(-n // width) * width, np.iinfo(u64).max)
    padded[:n] = g
    rows = padded.reshape(-1, width)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def runs_of(text: bytes, depth: int = DEPTH, gram: int = GRAM, section: int = SECTION) -> Iterator[tuple[np.ndarray, ...]]:
    """Per section of the text: digit, h1, h2, start, count of suffixes, and whether suffixes of the run may equal each other."""
    n = len(text) - depth + 1
    raw = np.frombuffer(text, np.uint8)
    for at in range(0, max(0, n), section):
        own = raw[at : min(n, at + section) + depth - 1]
        h = Hashes(own)
        grams = h.windows(0, gram)
        digit = sliding_min(grams, depth - gram + 1)
        start = np.flatnonzero(np.concatenate(([True], digit[1:] != digit[:-1])))
        end = np.concatenate((start[1:], [len(digit)]))
        # two equal suffixes in one run: the first of them holds a smallest string that the second no longer reaches
        leaves = np.concatenate(([0], np.cumsum((grams[: len(digit) - 1] == digit[:-1]) & (digit[1:] == digit[:-1]))))
        cyclic = leaves[end - 1] - leaves[start] > 0
        yield digit[start].view(np.int64), h.of(0, start, end - 1 + depth).view(np.int64), h.of(1, start, end - 1 + depth).view(np.int64), start + at, end - start, cyclic


def repeated_suffixes(segments: list[bytes], digits: np.ndarray, weights: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Segments (each count of suffixes + depth - 1 bytes long) -> (segment, offset) of the suffixes whose first depth bytes
    occur twice among suffixes of the same digit; a suffix of weight 2 counts as two. MSD radix sort, 8 bytes a pass."""
    sizes = np.array([len(s) for s in segments], np.int64)
    counts = sizes - depth + 1
    base = np.cumsum(sizes) - sizes
    raw = np.frombuffer(b"".join(segments) + bytes(8), np.uint8)
    owner = np.repeat(np.arange(len(segments)), counts)
    place = np.repeat(base, counts) + np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    group = np.unique(digits, return_inverse=True)[1][owner]
    words = np.lib.stride_tricks.sliding_window_view(raw, 8)
    for d in [*range(0, depth - 8, 8), depth - 8]:
        word = np.ascontiguousarray(words[place + d]).view(">u8").ravel().astype(u64)
        order = np.lexsort((word, group))
        owner, place, group, word = owner[order], place[order], group[order], word[order]
        first = np.concatenate(([True], (group[1:] != group[:-1]) | (word[1:] != word[:-1]))) if len(group) else np.zeros(0, bool)
        group = np.cumsum(first) - 1
        total = np.bincount(group, weights[owner]) if len(group) else np.zeros(0)
        stay = total[group] >= 2
        owner, place, group = owner[stay], place[stay], group[stay]
        if not len(group):
            break
    return owner, place - base[owner]


def merged(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(intervals):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for a, b in spans:
        parts.append(text[at:a])
        at = b
    return b"".join(parts) + text[at:]


RUN = "id bigint, th bigint, digit bigint, h1 bigint, h2 bigint, start bigint, n bigint, cyclic boolean"


def _runs(rows: DataFrame, depth: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, 4 << 20):
            at, cols = [], [[] for _ in range(6)]
            for i, t in enumerate(as_bytes(b.column("text"))):
                for part in runs_of(t, depth):
                    at.append(np.full(len(part[0]), i))
                    for c, x in zip(cols, part, strict=True):
                        c.append(x)
            if at:
                where = pa.array(np.concatenate(at))
                yield pa.RecordBatch.from_arrays([b.column("id").take(where), b.column("th").take(where), *(pa.array(np.concatenate(c)) for c in cols)], names=[x.split()[0] for x in RUN.split(", ")])

    return rows.mapInArrow(lean(run), RUN)


def repeated_intervals(rows: DataFrame, depth: int = DEPTH, hot: int = HOT_CONTENTS) -> DataFrame:
    """rows: id, th (hash of the text), text -> id, th, a, b: byte intervals that repeated windows cover, overlapping."""
    seen = _runs(rows, depth)
    shared = seen.groupBy(F.col("digit").alias("d")).agg(F.count(F.lit(1)).alias("times"), F.max("cyclic").alias("any_cyclic")).where("times > 1 OR any_cyclic").select("d")
    mine = cut(seen.join(shared, apart(F.col("digit")) == apart(F.col("d"))).drop("d"))
    release(rows.sparkSession)
    contents = mine.groupBy("digit", "h1", "h2", "n").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("id", "th", "start")).alias("owner"))
    per_digit = contents.groupBy(F.col("digit").alias("pd")).agg(F.count(F.lit(1)).alias("kinds"), F.min("times").alias("rarest"))
    known = contents.join(per_digit, apart(F.col("digit")) == apart(F.col("pd"))).select(F.col("digit").alias("kd"), F.col("h1").alias("k1"), F.col("h2").alias("k2"), F.col("n").alias("kn"), "times", "owner", "kinds", "rarest")
    same = (F.col("digit") == F.col("kd")) & (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")) & (F.col("n") == F.col("kn"))
    judged = cut(
        mine.join(known, same)
        .withColumn("whole", F.col("times") > 1)
        .withColumn("look", (~F.col("whole") & ((F.col("kinds") > 1) | F.col("cyclic"))) | (F.col("whole") & (F.col("kinds") > 1) & (F.col("rarest") == 1) & (F.struct("id", "th", "start") == F.col("owner"))))
        .where("whole OR look").select("id", "th", "digit", "start", "n", "whole", "look", (F.col("kinds") > hot).alias("hot"))
    )
    release(rows.sparkSession)
    found = judged.where("whole").select("id", "th", F.col("start").alias("a"), (F.col("start") + F.col("n") + depth - 1).alias("b"))

    wanted = judged.where("look").groupBy(F.col("id").alias("i"), F.col("th").alias("t")).agg(F.collect_list(F.struct("digit", "start", "n", "whole", "hot")).alias("runs"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bytes of cold runs; the hashes of each suffix of hot ones (digit: h1, h2)."""
        for b in text_slices(batches, 4 << 20):
            out = [[] for _ in range(8)]
            for i, th, text, runs in zip(b.column("id").to_pylist(), b.column("th").to_pylist(), as_bytes(b.column("text")), b.column("runs").to_pylist(), strict=True):
                for r in runs:
                    seg = text[r["start"] : r["start"] + r["n"] + depth - 1]
                    weight = 2 if r["whole"] else 1
                    if not r["hot"]:
                        for c, x in zip(out, (i, th, r["digit"], None, r["start"], weight, False, seg), strict=True):
                            c.append(x)
                        continue
                    h = Hashes(np.frombuffer(seg, np.uint8))
                    n = r["n"]
                    for c, x in zip(out, ([i] * n, [th] * n, h.windows(0, depth).view(np.int64).tolist(), h.windows(1, depth).view(np.int64).tolist(), range(r["start"], r["start"] + n), [weight] * n, [True] * n, [None] * n), strict=True):
                        c.extend(x)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["id", "th", "digit", "h2", "start", "weight", "hot", "seg"])

    texts = rows.join(wanted, (F.col("id") == F.col("i")) & (F.col("th") == F.col("t"))).select("id", "th", "text", "runs")
    fetched = cut(texts.mapInArrow(lean(fetch), "id bigint, th bigint, digit bigint, h2 bigint, start bigint, weight int, hot boolean, seg binary"))

    release(rows.sparkSession)

    def sort(key: tuple, got: pa.Table) -> pa.Table:
        owner, offset = repeated_suffixes(got.column("seg").to_pylist(), got.column("digit").to_numpy(), got.column("weight").to_numpy(), depth)
        start = got.column("start").to_numpy()[owner] + offset
        order = np.lexsort((start, owner))
        owner, start = owner[order], start[order]
        new = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (start[1:] > start[:-1] + depth)))) if len(owner) else np.zeros(0, np.int64)
        last = np.concatenate((new[1:], [len(owner)]))[: len(new)] - 1
        who = pa.array(owner[new])
        return pa.table({"id": got.column("id").take(who), "th": got.column("th").take(who), "a": pa.array(start[new]), "b": pa.array(start[last] + depth)})

    cold = fetched.where("NOT hot")
    buckets = max(1, math.ceil((cold.agg(F.sum(F.octet_length("seg"))).first()[0] or 0) / BUCKET_BYTES))
    sorted_ = cold.withColumn("bucket", F.pmod(F.xxhash64("digit"), F.lit(buckets))).groupBy("bucket").applyInArrow(lean_groups(sort), "id bigint, th bigint, a bigint, b bigint")
    warm = fetched.where("hot").select("id", "th", F.col("digit").alias("w1"), F.col("h2").alias("w2"), "start", "weight")
    twice = warm.groupBy(F.col("w1").alias("x1"), F.col("w2").alias("x2")).agg(F.sum("weight").alias("total")).where("total > 1")
    counted = warm.join(twice, apart(F.col("w1"), F.col("w2")) == apart(F.col("x1"), F.col("x2"))).select("id", "th", F.col("start").alias("a"), (F.col("start") + depth).alias("b"))
    return found.unionByName(sorted_).unionByName(counted)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(0)).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))


def cuts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, hot: int = HOT_CONTENTS) -> DataFrame:
    """id (null as 0), th, spans (array of struct a, b, overlapping, in bytes): a row for each text that loses something."""
    rows = _keyed(docs, id_col, text_col)
    with small_batches(docs.sparkSession):
        found = cut(repeated_intervals(rows, depth, hot))
    return found.groupBy(F.col("id").alias("i"), F.col("th").alias("t")).agg(F.collect_list(F.struct("a", "b")).alias("spans"))


def removal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, hot: int = HOT_CONTENTS) -> DataFrame:
    """id_col, n_bytes, n_removed, n_spans, kept_sha256, one row per input row."""
    rows = _keyed(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, 8 << 20):
            removed, spans, sha = [], [], []
            for text, own in zip(as_bytes(b.column("text")), b.column("spans").to_pylist(), strict=True):
                own = merged([(x["a"], x["b"]) for x in own])
                spans.append(len(own))
                removed.append(sum(e - s for s, e in own))
                sha.append(hashlib.sha256(without(text, own)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("i"), b.column("t"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string())], names=["i", "t", "removed", "spans", "sha"])

    lists = cuts(docs, id_col, text_col, depth, hot)
    losing = rows.join(lists, (F.col("id") == F.col("i")) & (F.col("th") == F.col("t"))).select("i", "t", "text", "spans").mapInArrow(lean(run), "i bigint, t bigint, removed bigint, spans bigint, sha string")
    # rows that repeat id and text would multiply in the join back
    losing = losing.groupBy("i", "t").agg(F.max("removed").alias("removed"), F.max("spans").alias("spans"), F.max("sha").alias("sha"))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    every = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("raw_id"), F.xxhash64(text).alias("th"), F.octet_length(text).cast("bigint").alias("n_bytes"), F.sha2(text, 256).alias("own_sha"))
    joined = every.join(losing, (F.coalesce("raw_id", F.lit(0)) == F.col("i")) & (F.col("th") == F.col("t")), "left")
    return joined.select(F.col("raw_id").alias(id_col), "n_bytes", F.coalesce("removed", F.lit(0)).cast("bigint").alias("n_removed"), F.coalesce("spans", F.lit(0)).cast("bigint").alias("n_spans"), F.coalesce("sha", "own_sha").alias("kept_sha256"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, length_col: str | None = "n_chars") -> DataFrame:
    """docs, all rows and columns, with repeated windows cut from the text; part of a character that a cut leaves is dropped.
    length_col, where present, becomes the number of characters that are left."""
    cut_at = free_name(docs.columns, "cut_at")
    lists = cuts(docs, id_col, text_col, depth).select(F.struct("i", "t", "spans").alias(cut_at))
    key, spans = (F.col(f"`{cut_at}`.{c}") for c in ("i", "spans"))

    @F.pandas_udf("string")
    def cut_text(text, spans):
        return text.combine(spans, lambda t, s: t if s is None else without((t or "").encode(), merged([(x["a"], x["b"]) for x in s])).decode("utf-8", "ignore"))

    text = F.col(f"`{text_col}`")
    joined = docs.join(lists, (F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(0)) == key) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col(f"`{cut_at}`.t")), "left")
    lost = joined.withColumn(text_col, F.when(spans.isNull(), text).otherwise(cut_text(text, spans)))
    if length_col in docs.columns:
        lost = lost.withColumn(length_col, F.when(spans.isNull(), F.col(f"`{length_col}`")).otherwise(F.char_length(text).cast(docs.schema[length_col].dataType)))
    return lost.select(*[F.col(f"`{c}`") for c in docs.columns])


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal(table(spark, sf_dir, "documents"))
