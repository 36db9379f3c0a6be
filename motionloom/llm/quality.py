"""Quality classifier: a factorisation machine over hashed words, structure statistics and length metadata.

score = sigmoid(w0 + sum w_i x_i + 1/2 sum_f [(sum v_if x_i)^2 - sum v_if^2 x_i^2]): the sum-of-squares identity makes the
pairwise interactions linear in the number of features that a text has. Trained in numpy on a bounded sample of labelled
rows; features are computed by the executors, so the driver gets the sample's features, never texts.

Defined results: null text counts as empty; an empty text gets a score like any other. Labels other than 0 and 1, and rows
without id, are not learned from. Several labels of one id are all used. With labels of one class or none, every text gets
the smoothed share of label 1. Repeated rows repeat; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionloom.llm.common import as_bytes, learnable, spread_ids, table, text_slices

WORD_BITS, BINS, FACTORS = 15, 8, 8
STATS = ("lower", "upper", "digit", "space", "newline", "stop", "mark", "pipe", "symbol", "other", "high", "word_length", "distinct_words", "repeated_lines", "caps_words", "chars")
N_WORDS = 1 << WORD_BITS
N_FEATURES = N_WORDS + len(STATS) * (1 + BINS)

_CLASS = np.full(256, 9, np.uint8)
for _k, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", b".,;:", b"!?'\"-", b"|", b"#$%&*@^~+=<>{}[]\\/_")):
    _CLASS[list(_chars)] = _k
_CLASS[128:] = 10


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers (distinct) and values of one text."""
    n = len(text)
    share = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=11)[:11] / max(1, n)
    words = text.split()
    lines = [x for x in text.split(b"\n") if x]
    distinct = len(set(words)) / max(1, len(words)) if words else 0.0
    repeated = 1 - len(set(lines)) / len(lines) if lines else 0.0
    caps = sum(map(bytes.isupper, words)) / max(1, len(words))
    stats = np.concatenate([share, [min(1.0, n / max(1, len(words)) / 20), distinct, repeated, caps, min(1.0, np.log1p(n) / 14)]])
    bins = np.minimum(BINS - 1, (np.sqrt(stats) * BINS).astype(np.int64))
    at = np.arange(len(STATS))
    hashed, counts = np.unique(np.fromiter(map(zlib.crc32, text.lower().split()), np.int64, len(words)) & (N_WORDS - 1), return_counts=True)
    weight = np.log1p(counts)
    if len(weight):
        weight = weight / np.sqrt((weight**2).sum())
    dense = N_WORDS + at * (1 + BINS)
    return np.concatenate([hashed, dense, dense + 1 + bins]), np.concatenate([weight, stats, np.full(len(STATS), 0.5)]).astype(np.float32)


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def logit(self, at: np.ndarray, x: np.ndarray) -> float:
        vx = self.factors[at] * x[:, None]
        return float(self.bias + self.linear[at] @ x + 0.5 * ((vx.sum(axis=0) ** 2).sum() - (vx**2).sum()))

    def score(self, text: bytes) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logit(*features(text)), -30, 30))))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 8, batch: int = 128, rate: float = 0.05, decay: float = 1e-5, seed: int = 5) -> Machine:
    """Logistic loss, AdaGrad over the features that a batch touches."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    rng = np.random.default_rng(seed)
    bias, linear = float(np.log(share / (1 - share))), np.zeros(N_FEATURES, np.float32)
    factors = rng.normal(0, 0.02, (N_FEATURES, FACTORS)).astype(np.float32)
    if len(set(labels.tolist())) < 2:
        return Machine(bias, linear, np.zeros_like(factors))
    g_bias, g_linear, g_factors = 1e-6, np.full(N_FEATURES, 1e-6, np.float32), np.full((N_FEATURES, FACTORS), 1e-6, np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for s in range(0, len(order), batch):
            own = order[s : s + batch]
            at = np.concatenate([rows[i][0] for i in own])
            x = np.concatenate([rows[i][1] for i in own])
            sizes = np.array([len(rows[i][0]) for i in own])
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            v = factors[at]
            vx = v * x[:, None]
            sums = np.add.reduceat(vx, starts)
            logit = bias + np.add.reduceat(linear[at] * x, starts) + 0.5 * ((sums**2).sum(axis=1) - np.add.reduceat((vx**2).sum(axis=1), starts))
            err = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[own]) / len(own)).astype(np.float32)
            each = np.repeat(err, sizes) * x
            touched, place = np.unique(at, return_inverse=True)
            d_linear = np.bincount(place, each, len(touched)).astype(np.float32) + decay * linear[touched]
            d_each = each[:, None] * (np.repeat(sums, sizes, axis=0) - vx)
            d_factors = np.stack([np.bincount(place, d_each[:, f], len(touched)) for f in range(FACTORS)], axis=1).astype(np.float32) + decay * factors[touched]
            d_bias = float(err.sum())
            g_bias += d_bias**2
            g_linear[touched] += d_linear**2
            g_factors[touched] += d_factors**2
            bias -= rate * d_bias / g_bias**0.5
            linear[touched] -= 4 * rate * d_linear / np.sqrt(g_linear[touched])
            factors[touched] -= rate * d_factors / np.sqrt(g_factors[touched])
    return Machine(bias, linear, factors)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most_rows: int = 6000) -> Machine:
    """most_rows: the bound on labelled rows learned from, taken in an order of hashed ids. Held-out ids are never among them."""
    chosen = (
        labels.select(F.col(f"`{id_col}`").cast("bigint").alias("lid"), F.col(f"`{label_col}`").cast("int").alias("label"))
        .where(learnable(F.col("lid")) & F.col("label").isin(0, 1)).orderBy(spread_ids(F.col("lid")), "lid", "label").limit(most_rows)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, 8 << 20):
            got = [features(t) for t in as_bytes(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), pa.array([g[0].astype("<i4").tobytes() for g in got], pa.binary()), pa.array([g[1].tobytes() for g in got], pa.binary())], names=["id", "label", "at", "x"])

    src = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    made = src.join(F.broadcast(chosen), F.col("id") == F.col("lid")).select("id", "text", "label").mapInArrow(run, "id bigint, label int, at binary, x binary")
    got = made.orderBy(spread_ids(F.col("id")), "id", "label", "at", "x").limit(most_rows).toArrow()  # an id may repeat in docs
    rows = sorted(zip(got["id"].to_pylist(), got["label"].to_pylist(), got["at"].to_pylist(), got["x"].to_pylist(), strict=True))[:most_rows]
    return train([(np.frombuffer(a, "<i4").astype(np.int64), np.frombuffer(x, np.float32)) for _, _, a, x in rows], np.array([r[1] for r in rows], np.float32))


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score, one row per input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, 8 << 20):
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([machine.score(t) for t in as_bytes(b.column("text"))], pa.float64())], names=["id", "score"])

    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, "id bigint, score double")


def keep_quality(docs: DataFrame, machine: Machine, least: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, whose text scores at least `least`. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, 8 << 20, text_col):
            yield b.filter(pa.array([machine.score(t) >= least for t in as_bytes(b.column(text_col))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(F.col("id").alias("doc_id"), (~learnable(F.col("id"))).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
