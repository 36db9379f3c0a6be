"""The registered queries over a whole table against brute force, and the pipeline against a plain version of it."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from motionloom.llm import bpe
from motionloom.llm import queries as Q

tokenizers = pytest.importorskip("tokenizers")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark, sf):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]


def library(name):
    tok = tokenizers.Tokenizer.from_file(bpe.vocabulary_path(name))
    tok.no_truncation()
    tok.no_padding()
    return tok


def raw(ids):
    return np.array(ids, "<u4").tobytes()


def pieces(doc, ids):
    out, at = [], 0
    for k in [4096] * (len(ids) // 4096) + [1 << b for b in range(11, -1, -1) if len(ids) % 4096 >> b & 1]:
        out.append((doc, at, k, zlib.crc32(raw(ids[at : at + k])), len(ids)))
        at += k
    return out


def repeated(texts, depth=200):
    seen = Counter(t[p : p + depth] for t in texts for p in range(len(t) - depth + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, int)
        for p in range(len(t) - depth + 1):
            if seen[t[p : p + depth]] > 1:
                gone[p] += 1
                gone[p + depth if p + depth <= len(t) else len(t)] -= 1
        out.append(np.cumsum(gone)[: len(t)] > 0)
    return out


def near_groups(rows):
    sets = []
    for _, t in rows:
        w = [x.translate(LOWER) for x in WORD.findall(t)]
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))})
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if root[i] != root[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    return root


def test_op3(spark, sf, docs):
    tok = library(bpe.WORD_BPE)
    want = []
    for i, t in docs:
        ids = tok.encode(t, add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(raw(ids)).hexdigest(), hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    got = Q.queries()["op3_bpe_encode_decode"](spark, sf).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_op6(spark, sf, docs):
    fps = []
    for _, t in docs:
        w = [x.translate(LOWER) for x in WORD.findall(t)]
        h = [xxhash.xxh64_intdigest(" ".join(w[k : k + 3]).encode(), 42) for k in range(max(1, len(w) - 2))] if w else []
        fps.append(sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)))
    root = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if root[i] != root[j] and (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    low = {r: min(docs[k][0] for k in range(len(docs)) if root[k] == r) for r in set(root)}
    want = sorted((i, f"{f:016x}", low[r]) for (i, _), f, r in zip(docs, fps, root, strict=True))
    assert sorted(map(tuple, Q.queries()["op6_simhash_near_dedup"](spark, sf).select("doc_id", "fingerprint", "component_id").collect())) == want


def test_op7(spark, sf, docs):
    tok, want, at = library(bpe.BYTE_BPE), [], 0
    for i, t in sorted(docs):
        ids = [*tok.encode(t, add_special_tokens=False).ids, 0]
        want.append((i, at, len(ids), zlib.crc32(raw(ids))))
        at += len(ids)
    assert sorted(map(tuple, Q.queries()["op7_token_files"](spark, sf).select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == want


def test_op8(spark, sf, docs):
    texts = [t.encode() for _, t in docs]
    want = []
    for (i, _), t, gone in zip(docs, texts, repeated(texts), strict=True):
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum())
        want.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()))
    assert sorted(map(tuple, Q.queries()["op8_suffix_dedup"](spark, sf).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())) == sorted(want)


def test_op10(spark, sf, docs):
    tok = library(bpe.WORD_BPE)
    got = Q.queries()["op10_packing"](spark, sf).collect()
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == sorted(p for i, t in docs for p in pieces(i, [*tok.encode(t, add_special_tokens=False).ids, 2]))
    assert sorted(r.sequence_id for r in got) == list(range(len(got))) and {r.offset for r in got} == {0}


@pytest.mark.parametrize("name, target", [("op1_language_id", "lang"), ("op9_quality_classifier", "quality")])
def test_learned(spark, sf, docs, name, target):
    """Held-out rows are those of the contract, every row is scored, and the held-out rows are mostly right."""
    got = {r.doc_id: r for r in Q.queries()[name](spark, sf).collect()}
    assert set(got) == {i for i, _ in docs} and all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 for i, r in got.items())
    known = {r.doc_id: r[target] for r in spark.read.parquet(f"{sf}/{'documents' if target == 'lang' else 'labels'}.parquet").select("doc_id", target).collect() if r[target] is not None}
    guess = {i: r.lang_pred if target == "lang" else r.predicted for i, r in got.items()}
    tested = [i for i in known if got[i].held_out]
    assert sum(guess[i] == known[i] for i in tested) >= 0.75 * len(tested)


def test_pipeline(spark, sf):
    """After the classifier, whose decisions are its own, the rows of run() are those of a plain version of the other stages."""
    table = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sorted((r.doc_id, r.text or "") for r in corpus_pipeline.quality_stage(spark, table, sf).collect())
    first = {}
    for i, t in rows:
        first.setdefault(t.translate(LOWER), (i, t))
    rows = sorted(first.values())
    kept = {}
    for r, row in zip(near_groups(rows), rows, strict=True):
        kept.setdefault(r, row)
    rows = sorted(kept.values())
    texts = [t.encode() for _, t in rows]
    left = [bytes(np.frombuffer(t, np.uint8)[~gone]).decode("utf-8", "ignore") for t, gone in zip(texts, repeated(texts), strict=True)]
    tok = library(bpe.WORD_BPE)
    want = sorted(p for (i, _), t in zip(rows, left, strict=True) for p in pieces(i, [*tok.encode(t, add_special_tokens=False).ids, 2]))
    got = corpus_pipeline.run(spark, sf).collect()
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
