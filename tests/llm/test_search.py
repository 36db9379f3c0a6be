"""Words against the regular expression, and the search against a score of every document."""

import math
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from motionloom.llm import search
from motionloom.llm.words import words_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    """(item place, rank, doc_id, score)."""
    own = [(i, Counter(terms(t))) for i, t in docs]
    own = [(i, c, c.total()) for i, c in own if c]
    n, total = len(own), sum(x[2] for x in own)
    df = Counter(t for _, c, _ in own for t in c)
    out = []
    for place, (_, text) in enumerate(items):
        scores = []
        for i, c, size in own:
            m = 100 - 90 + (90 * size * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(place, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k])]
    return out


def test_words():
    texts = ["", None, "A b", "b", "ÄÖ x\x00y_z`0{9", "é", "\U0001f600a", "   ", "AB", "-AB-"]
    for lo, hi in ((0, 10), (2, 7), (3, 3), (7, 8), (8, 10)):
        words, counts = words_of(pa.array(texts)[lo:hi])
        assert [w.decode() for w in words.to_pylist()] == [w for t in texts[lo:hi] for w in terms(t)]
        assert counts.tolist() == [len(terms(t)) for t in texts[lo:hi]]


@pytest.mark.parametrize("block, candidates, size", [(200_000, 64, 8 << 20), (40, 3, 400), (40, 0, 3000)])
def test_equals_brute_force(spark, monkeypatch, block, candidates, size):
    for name, value in (("BLOCK_TERMS", block), ("CANDIDATES", candidates), ("SLICE_BYTES", size)):
        monkeypatch.setattr(search, name, value)
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["ü", "Ж", "x1"]
    draw = lambda n: " ".join(vocabulary[min(int(rng.expovariate(0.1)), 62)] for _ in range(n))
    docs = [(i, draw(rng.choice([1, 3, 20, 80]))) for i in range(250)] + [(1000 + i, "w3 w4 W5") for i in range(30)]
    docs += [(None, "w3 w4 w5"), (None, None), (7, "w1 w1 ü"), (2000, ""), (2001, "..."), (2002, draw(4000))]
    items = [(i, draw(rng.choice([1, 4, 15, 40]))) for i in range(25)] + [(90, None), (91, "!"), (3, "W3 w5"), (92, "nowhere"), (None, "ü")]
    got = defaultdict(list)
    table = search.search(spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id bigint, text string, rank int").repartition(3), spark.createDataFrame([(i, t, 0) for i, t in items], "item_id bigint, text string, number int"))
    assert table.columns == ["item_id", "rank", "doc_id", "score"]
    for r in table.collect():
        got[r.item_id].append((r.rank, r.doc_id, r.score))
    want = defaultdict(list)
    for place, *row in brute(docs, items):
        want[items[place][0]].append(tuple(row))
    plain = lambda x: {k: sorted(map(str, v)) for k, v in x.items()}
    assert plain(got) == plain(want)


def test_stops_early(spark):
    """Where few documents hold the rare terms, most postings of the common one are never added."""
    import numpy as np

    vocabulary = pa.array([b"common", b"rare"], pa.large_binary())
    texts = pa.array(["common " * (1 + i % 9) + ("rare rare" if i in (5, 6) else "") for i in range(3000)])
    index = search.Slice(texts, vocabulary, 3000, 15_000)
    docs, scores = index.search(np.array([0, 1]), np.array([1, 7000]), 2, 0)
    assert set(docs[np.argsort(-scores)[:2]].tolist()) == {5, 6} and len(docs) <= search.CANDIDATES


def test_empty_tables(spark, sf):
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    assert search.search(docs.where("false"), items).count() == 0
    assert search.search(docs, items.where(F.lit(False))).count() == 0
