"""Language identification: a bidirectional gated recurrent network over bytes, trained in numpy by backpropagation
through time. It labels every position of the whole text; a document's probabilities are the mean over its positions.

The cell has one gate f and a candidate n: f = sigmoid(Tf[byte] + h Uf), n = tanh(Tn[byte] + f * (h Un)), h' = h + f (n - h).
Texts are run in chunks of equal length side by side; each chunk starts from the zero state in both directions, so memory
does not depend on the length of a text.

Defined results: `und` with score 0 for a text that is null or has no letter, and for every text if nothing could be
learned. Learned from: bounded random places of a bounded number of texts whose language is not null. Repeated rows
repeat; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionloom.llm.common import learnable, spread_ids, table, text_slices

HIDDEN, CHUNK, LANES = 8, 256, 4096
SEGMENT, SEGMENTS_PER_TEXT = 96, 6
f32 = np.float32


@dataclass
class Direction:
    gate_in: np.ndarray  # 256 x H
    cand_in: np.ndarray
    gate_h: np.ndarray  # H x H
    cand_h: np.ndarray

    @staticmethod
    def new(rng: np.random.Generator) -> Direction:
        return Direction(*(rng.normal(0, s, (n, HIDDEN)).astype(f32) for n, s in ((256, 0.3), (256, 0.3), (HIDDEN, 0.3), (HIDDEN, 0.3))))

    def states(self, chunks: np.ndarray, active: np.ndarray, backward: bool) -> np.ndarray:
        """chunks: T x L bytes, lanes by falling length; active[t]: how many lanes reach step t. Returns T x L x H."""
        t_all, lanes = chunks.shape
        out = np.zeros((t_all, lanes, HIDDEN), f32)
        state = np.zeros((lanes, HIDDEN), f32)
        a, c, x = (np.empty((lanes, HIDDEN), f32) for _ in range(3))
        half_in, half_h = self.gate_in * f32(0.5), self.gate_h * f32(0.5)
        for t in range(t_all - 1, -1, -1) if backward else range(t_all):
            n = int(active[t])
            b, h, f, k, y = chunks[t, :n], state[:n], a[:n], c[:n], x[:n]
            np.matmul(h, half_h, out=f)
            np.take(half_in, b, axis=0, out=y, mode="clip")
            f += y
            np.tanh(f, out=f)
            f *= f32(0.5)
            f += f32(0.5)
            np.matmul(h, self.cand_h, out=k)
            k *= f
            np.take(self.cand_in, b, axis=0, out=y, mode="clip")
            k += y
            np.tanh(k, out=k)
            k -= h
            k *= f
            h += k
            out[t, :n] = h
        return out


@dataclass
class Network:
    langs: list[str]
    forward: Direction
    backward: Direction
    out: np.ndarray  # 2H x C
    bias: np.ndarray

    def position_probabilities(self, chunks: np.ndarray, active: np.ndarray) -> np.ndarray:
        """T x L x C; positions beyond a lane's length are zero."""
        logits = self.forward.states(chunks, active, False) @ self.out[:HIDDEN]
        logits += self.backward.states(chunks, active, True) @ self.out[HIDDEN:]
        logits += self.bias
        logits -= logits.max(axis=2, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=2, keepdims=True)
        logits *= (np.arange(chunks.shape[1])[None, :] < active[:, None])[:, :, None]
        return logits

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        """Texts x languages: the mean over all positions; zero for empty texts."""
        sizes = np.array([len(t) for t in texts], np.int64)
        per = -(-sizes // CHUNK)
        owner = np.repeat(np.arange(len(texts)), per)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
        starts = (np.cumsum(sizes) - sizes)[owner] + nth * CHUNK
        lengths = np.minimum(CHUNK, sizes[owner] - nth * CHUNK)
        raw = np.frombuffer(b"".join(texts) + bytes(CHUNK), np.uint8)
        order = np.argsort(-lengths, kind="stable")
        sums = np.zeros((len(texts), len(self.langs)))
        for s in range(0, len(order), LANES):
            own = order[s : s + LANES]
            longest = int(lengths[own[0]])
            chunks = raw[starts[own][None, :] + np.arange(longest)[:, None]]
            active = np.searchsorted(-lengths[own], -np.arange(longest), side="left")
            np.add.at(sums, owner[own], self.position_probabilities(chunks, active).sum(axis=0, dtype=np.float64))
        return sums / np.maximum(sizes, 1)[:, None]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        sure = [any(map(str.isalpha, t)) if t else False for t in texts]
        if not self.langs:
            sure = [False] * len(texts)
            probs = np.zeros((len(texts), 1))
        else:
            probs = self.probabilities([t.encode() if ok else b"" for t, ok in zip(texts, sure, strict=True)])
        best = probs.argmax(axis=1)
        return [self.langs[b] if ok else "und" for b, ok in zip(best, sure, strict=True)], [float(min(1.0, probs[i, b])) if ok else 0.0 for i, (b, ok) in enumerate(zip(best, sure, strict=True))]


def _run(d: Direction, chunks: np.ndarray) -> tuple:
    """Forward with everything that backpropagation needs; chunks: T x B, all of full length."""
    h = np.zeros((chunks.shape[1], HIDDEN), f32)
    kept = []
    for b in chunks:
        f = 1 / (1 + np.exp(-(d.gate_in[b] + h @ d.gate_h)))
        c = h @ d.cand_h
        n = np.tanh(d.cand_in[b] + f * c)
        kept.append((h, f, c, n))
        h = h + f * (n - h)
    return [x[0] for x in kept[1:]] + [h], kept


def _back(d: Direction, chunks: np.ndarray, kept: list, d_states: np.ndarray) -> list[np.ndarray]:
    g_gate_h, g_cand_h = np.zeros_like(d.gate_h), np.zeros_like(d.cand_h)
    pre_f, pre_n = np.empty_like(d_states), np.empty_like(d_states)
    dh = np.zeros_like(d_states[0])
    for t in range(len(kept) - 1, -1, -1):
        h, f, c, n = kept[t]
        dh = dh + d_states[t]
        pre_n[t] = dh * f * (1 - n * n)
        pre_f[t] = (dh * (n - h) + pre_n[t] * c) * f * (1 - f)
        dc = pre_n[t] * f
        g_cand_h += h.T @ dc
        g_gate_h += h.T @ pre_f[t]
        dh = dh * (1 - f) + dc @ d.cand_h.T + pre_f[t] @ d.gate_h.T
    flat = chunks.ravel()
    table_of = lambda g: np.stack([np.bincount(flat, g[:, :, k].ravel(), 256) for k in range(HIDDEN)], axis=1).astype(f32)
    return [table_of(pre_f), table_of(pre_n), g_gate_h, g_cand_h]


def train(segments: list[bytes], langs: list[str], steps: int = 500, batch: int = 192, rate: float = 0.02, seed: int = 11) -> Network:
    """Cross-entropy at every position, Adam; languages are drawn evenly. Segments shorter than SEGMENT are repeated to it."""
    names = sorted(set(langs))
    rng = np.random.default_rng(seed)
    fwd, bwd = Direction.new(rng), Direction.new(rng)
    out, bias = rng.normal(0, 0.3, (2 * HIDDEN, len(names))).astype(f32), np.zeros(len(names), f32)
    if not names:
        return Network([], fwd, bwd, out, bias)
    rows = np.frombuffer(b"".join((s * (SEGMENT // len(s) + 1))[:SEGMENT] for s in segments), np.uint8).reshape(-1, SEGMENT)
    number = np.array([names.index(x) for x in langs])
    pools = [np.flatnonzero(number == k) for k in range(len(names))]
    params = [fwd.gate_in, fwd.cand_in, fwd.gate_h, fwd.cand_h, bwd.gate_in, bwd.cand_in, bwd.gate_h, bwd.cand_h, out, bias]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        y = rng.integers(0, len(names), batch)
        chunks = np.ascontiguousarray(rows[[rng.choice(pools[k]) for k in y]].T)
        hf, kf = _run(fwd, chunks)
        hb, kb = _run(bwd, chunks[::-1])
        states = np.concatenate([np.stack(hf), np.stack(hb)[::-1]], axis=2)
        logits = states @ out + bias
        p = np.exp(logits - logits.max(axis=2, keepdims=True))
        p /= p.sum(axis=2, keepdims=True)
        p[:, np.arange(batch), y] -= 1
        p = (p / p[..., 0].size).astype(f32)
        d_states = p @ out.T
        grads = [*_back(fwd, chunks, kf, d_states[..., :HIDDEN]), *_back(bwd, chunks[::-1], kb, np.ascontiguousarray(d_states[::-1, :, HIDDEN:])), states.reshape(-1, 2 * HIDDEN).T @ p.reshape(-1, len(names)), p.sum(axis=(0, 1))]
        norm = np.sqrt(sum(float((g**2).sum()) for g in grads))
        for k, g in enumerate(grads):
            g = g / max(1.0, norm)
            m[k] += 0.1 * (g - m[k])
            v[k] += 0.01 * (g * g - v[k])
            params[k] -= (rate * min(1.0, 2 * (1 - step / (steps + 1))) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(f32)
    return Network(names, fwd, bwd, out, bias)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most_texts: int = 2400) -> Network:
    """most_texts: the bound on texts learned from, in an order of hashed ids. The driver gets SEGMENTS_PER_TEXT pieces of
    SEGMENT bytes from random places of each, nothing else."""
    src = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang")).where(learnable(F.col("id")) & F.col("lang").isNotNull())
    chosen = src.select(F.col("id").alias("cid")).orderBy(spread_ids(F.col("cid")), "cid").limit(most_texts).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, 8 << 20):
            ids, langs, parts = [], [], []
            for i, text, lang in zip(b.column("id").to_pylist(), b.column("text").to_pylist(), b.column("lang").to_pylist(), strict=True):
                if text and any(map(str.isalpha, text)):
                    raw, rng = text.encode(), np.random.default_rng(abs(i))
                    for _ in range(SEGMENTS_PER_TEXT if len(raw) > SEGMENT else 1):
                        s = int(rng.integers(0, max(1, len(raw) - SEGMENT + 1)))
                        ids.append(i)
                        langs.append(lang)
                        parts.append(raw[s : s + SEGMENT])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(langs, pa.string()), pa.array(parts, pa.binary())], names=["id", "lang", "part"])

    pieces = src.join(F.broadcast(chosen), F.col("id") == F.col("cid")).select("id", "text", "lang").mapInArrow(run, "id bigint, lang string, part binary")
    got = pieces.orderBy(spread_ids(F.col("id")), "id", "lang", "part").limit(most_texts * SEGMENTS_PER_TEXT).toArrow()  # an id may repeat
    rows = sorted(zip(got["id"].to_pylist(), got["lang"].to_pylist(), got["part"].to_pylist(), strict=True))
    return train([r[2] for r in rows], [r[1] for r in rows])


def identify(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score, one row per input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, 8 << 20):
            pred, score = network.predict(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=["id", "lang_pred", "score"])

    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, "id bigint, lang_pred string, score double")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, fit(docs))
    return found.select(F.col("id").alias("doc_id"), (~learnable(F.col("id"))).alias("held_out"), "lang_pred", "score")
