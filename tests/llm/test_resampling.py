"""Resampling against a plain count of every n-gram."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from motionloom.llm import resampling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(docs, target):
    def features(text):
        w = WORD.findall((text or "").translate(LOWER))
        return w, [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = (Counter(bucket(f) for x in texts for f in features(x)[1]) for texts in ([x for _, x in docs], target))
    big_s, big_t = s.total(), t.total()
    rows = []
    for i, text in docs:
        w, f = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000)))) for b in map(bucket, f))
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w) >= 20])
    may = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = 5 * len(may) // 100
    ranks = {id(r): k + 1 for k, r in enumerate(may[:drawn])}
    return sorted(str((*r[:4], ranks.get(id(r)))) for r in rows)


@pytest.mark.parametrize("run, size", [(1_500_000, 8 << 20), (50, 3000), (1, 100)])
def test_equals_brute_force(spark, monkeypatch, run, size):
    monkeypatch.setattr(resampling, "RUN_WORDS", run)
    monkeypatch.setattr(resampling, "SLICE_BYTES", size)
    rng = random.Random(2)
    words = ["the", "of", "Ab", "é", "x1", "ж", *[f"w{i}" for i in range(200)]]
    draw = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(words[: rng.choice([6, 200])]) for _ in range(n))
    docs = [(i, draw(rng.choice([0, 1, 2, 3, 19, 20, 45]))) for i in range(160 if run > 1 else 30)] + [(500, "of the " * 700), (501, None), (502, "  !"), (None, draw(30)), (None, draw(30)), (7, "a b"), (7, "a b")]
    target = [draw(12) for _ in range(10)] + [None, ""]
    got = resampling.resample(spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id bigint, text string, rank int, may int").repartition(4), spark.createDataFrame([(t,) for t in target], "text string"))
    assert sorted(str(tuple(r)) for r in got.select("doc_id", "n_features", "weight", "score", "rank").collect()) == brute(docs, target)


def test_query(spark, sf):
    docs, target = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    got = resampling.op13_importance_resampling(spark, sf).collect()
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])
    assert sorted(str((r.doc_id, r.n_features, r.weight, r.score, r["rank"])) for r in got) == want


def test_empty_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert resampling.resample(docs.where("false"), docs).count() == 0
    one = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    assert resampling.resample(one, docs.where("false").select("text")).first().n_features == 6


def test_strings_of_a_part_stay_in_arrow():
    """Parts are put together, cut into pairs and hashed on buffers; no list of strings is made of them."""
    triples = [b"a b c", b"a b ", b"\xc3\xa9 b c", b"a b c", b"x y zz"]
    strings, counts, part = pa.array(triples, pa.large_binary()), np.array([1, 2, 3, 4, 5]), np.array([1, 0, 1, 0, 1])
    _, blobs, times = resampling.packed(strings, counts, part)
    found, total = resampling.unpacked(blobs, times)
    assert isinstance(found, pa.Array) and dict(zip(found.to_pylist(), total.tolist(), strict=True)) == {b"a b c\n": 5, b"a b \n": 2, b"\xc3\xa9 b c\n": 3, b"x y zz\n": 5}
    for some in (found, found[1:], found[:0]):
        own = [x[:-1] for x in some.to_pylist()]
        assert resampling.hashes(some, 1).tolist() == [zlib.crc32(x) for x in own]
        pairs, ended = resampling.first_two(some)
        assert pairs.to_pylist() == [x.rpartition(b" ")[0] for x in own] and ended.tolist() == [x.endswith(b" ") for x in own]
    none, total = resampling.unpacked([], [])
    assert len(none) == len(total) == len(resampling.hashes(none, 1)) == 0
