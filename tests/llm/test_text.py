"""Encoding, packing, token files, language and quality, on small texts and against plain code."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from motionloom.llm import bpe, langid, packing, quality, token_files

tokenizers = pytest.importorskip("tokenizers")
ODD = ["", "a", "  ", "Hello, WORLD's 123 ½²", "<|endoftext|>", "x<|endoftext|>y <|startoftext|>", "naïve Σςσ ŁÓDŹ İı", "中文 漢字 カナ 😀👍🏽", "\t\n\r\x0b\x1c\x85\xa0 　end  ", "aaaaaaaaaaaa" * 40, "ﬁ é É `\x00", "don't we'll I'M"]


def library(name):
    return tokenizers.Tokenizer.from_file(bpe.vocabulary_path(name))


@pytest.mark.parametrize("name", [bpe.WORD_BPE, bpe.BYTE_BPE])
@pytest.mark.parametrize("own", [False, True])
def test_equals_the_library(name, own):
    lib, tok = library(name), bpe.Bpe(bpe.vocabulary_path(name), library=own)
    for text, ids in zip(ODD, tok.encode_slice(ODD), strict=True):
        expected = lib.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected
        assert tok.decode(ids).decode() == lib.decode(expected, skip_special_tokens=False)


LIB = {n: library(n) for n in (bpe.WORD_BPE, bpe.BYTE_BPE)}
TOK = {n: bpe.Bpe(bpe.vocabulary_path(n)) for n in LIB}


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=60))
def test_any_text_equals_the_library(text):
    for n, tok in TOK.items():
        assert np.frombuffer(next(tok.encode_slice([text])), "<u4").tolist() == LIB[n].encode(text, add_special_tokens=False).ids


def test_pieces_in_one_batch_equal_the_plain_loop():
    tok = TOK[bpe.WORD_BPE]
    rng = np.random.default_rng(2)
    pieces = ["".join(rng.choice(list("abcdenorst"), rng.integers(1, 25))).encode() for _ in range(400)]
    assert [x.tolist() for x in tok.encode_pieces(pieces)] == [tok.encode_one(p).tolist() for p in pieces]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash") for i, t in enumerate(ODD)] + [(50, None, "x"), (51, "word " * 9000, "x"), (3, ODD[3], "again"), (None, "no id", "x")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, ids string")


def test_digest_columns(docs):
    lib = LIB[bpe.WORD_BPE]
    for r, t in zip(*(sorted(x, key=lambda y: (str(y[0]), str(y[1]))) for x in ([tuple(r) for r in bpe.digests(docs, bpe.vocabulary_path(bpe.WORD_BPE)).collect()], [(r.doc_id, len(lib.encode(r.text or "", add_special_tokens=False).ids), r.text) for r in docs.collect()])), strict=True):
        ids = lib.encode(t[2] or "", add_special_tokens=False).ids
        assert r == (t[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_encode_decode_tables(docs):
    path = bpe.vocabulary_path(bpe.BYTE_BPE)
    back = {r.id: r.text for r in bpe.decode(bpe.encode(docs, path), path).collect()}
    assert back[50] == "" and back[3] == ODD[3] and back[7] == ODD[7]


def test_binary_lengths():
    for n in (1, 2, 4095, 4096, 4097, 9000):
        parts = packing.binary_lengths(n)
        assert sum(parts) == n and all(p & (p - 1) == 0 and p <= 4096 for p in parts) and parts == sorted(parts, reverse=True)


def test_packing_covers_each_document_once(spark, docs, monkeypatch):
    monkeypatch.setattr(packing, "SLICE_PIECES", 5)
    got = packing.pack(docs, bpe.vocabulary_path(bpe.WORD_BPE)).collect()
    lib = LIB[bpe.WORD_BPE]
    assert sorted(r.sequence_id for r in got) == list(range(len(got))) and all(r.offset == 0 for r in got)
    by_length = sorted(got, key=lambda r: r.sequence_id)
    assert [r.length for r in by_length] == sorted((r.length for r in got), reverse=True)
    for d in docs.select("doc_id", "text").distinct().collect():
        ids = np.array([*lib.encode(d.text or "", add_special_tokens=False).ids, 2], "<u4")
        own = sorted({(r.start, r.length, r.ids_crc32, r.doc_tokens, bytes(r.ids)) for r in got if r.doc_id == d.doc_id})
        assert b"".join(o[4] for o in own) == ids.tobytes() and all(o[2] == zlib.crc32(o[4]) and o[3] == len(ids) for o in own)
        assert [o[0] for o in own] == np.cumsum([0, *[o[1] for o in own[:-1]]]).tolist()
    assert packing.pack(docs.where("false"), bpe.vocabulary_path(bpe.WORD_BPE)).count() == 0


@pytest.mark.parametrize("ids", [[], [0], [65535] * 5000, list(range(9000)), np.random.default_rng(1).integers(0, 65536, 13000), np.random.default_rng(2).integers(0, 3, 13000)])
def test_coder_round_trip_and_size(ids):
    ids = np.asarray(ids, np.int64)
    blocks = [ids[k : k + token_files.BLOCK] for k in range(0, len(ids), token_files.BLOCK)]
    coded = token_files.encode_blocks(blocks)
    assert [b.tolist() for b in token_files.decode_blocks(coded, [len(b) for b in blocks])] == [b.tolist() for b in blocks]
    if len(set(ids.tolist())) < 4 and len(ids) > 1000:
        assert sum(map(len, coded)) < len(ids) / 2


def test_token_files_are_smaller_than_deflate():
    """Whole table; the plain format is 16-bit words."""
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet").sort_by("doc_id")["text"].to_pylist()
    tok = bpe.bpe(bpe.vocabulary_path(bpe.BYTE_BPE), library=True)
    ids = np.frombuffer(b"".join(x + bytes(4) for s in range(0, len(texts), 200) for x in tok.encode_slice([t or "" for t in texts[s : s + 200]])), "<u4")
    blocks = [ids[k : k + token_files.BLOCK] for k in range(0, len(ids), token_files.BLOCK)]
    coded = token_files.encode_blocks(blocks)
    assert sum(map(len, coded)) < len(zlib.compress(ids.astype("<u2").tobytes(), 9))
    back = token_files.decode_blocks(coded, [len(b) for b in blocks])
    assert all((a == b).all() for a, b in zip(back, blocks, strict=True))


@pytest.mark.parametrize("n", [0, 1, 2, 255, 257, 1023, 1025, 5000, 40000])
@pytest.mark.parametrize("kinds", [1, 3, 900, 65536])
def test_coder_round_trip(n, kinds):
    ids = np.random.default_rng(n + kinds).integers(0, kinds, n)
    blocks = [ids[k : k + token_files.BLOCK] for k in range(0, n, token_files.BLOCK)]
    back = token_files.decode_blocks(token_files.encode_blocks(blocks), [len(b) for b in blocks])
    assert [b.tolist() for b in back] == [b.tolist() for b in blocks]


def test_token_files_number_rows_of_one_id_in_the_order_of_their_texts(spark, tmp_path):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(7, f"text {k}" * (k % 3)) for k in range(40)] + [(None, "none"), (9, None)], "doc_id long, text string")
    twice = [[tuple(r) for r in token_files.read(token_files.write(rows.repartition(n).orderBy(F.rand(n)), bpe.vocabulary_path(bpe.BYTE_BPE), f"file://{tmp_path}/{n}")).orderBy("start").collect()] for n in (2, 5)]
    assert twice[0] == twice[1] and len(twice[0]) == 42 and twice[0][0][0] is None


def test_token_files(spark, docs, tmp_path):
    manifest = token_files.write(docs, bpe.vocabulary_path(bpe.BYTE_BPE), f"file://{tmp_path}/t")
    got = token_files.read(manifest).orderBy("start").collect()
    lib, at = LIB[bpe.BYTE_BPE], 0
    order = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    for r, d in zip(got, order, strict=True):
        ids = [*lib.encode(d.text or "", add_special_tokens=False).ids, 0]
        assert (r.doc_id, r.start, r.n_tokens) == (d.doc_id, at, len(ids)) and r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    uri = manifest.first().file
    path = uri.removeprefix("file://")
    raw = bytearray(open(path, "rb").read())
    raw[12] ^= 1
    open(path, "wb").write(raw)
    with pytest.raises(ValueError):
        list(token_files.TokenReader(uri).documents())
    assert token_files.read(token_files.write(docs.where("false"), bpe.vocabulary_path(bpe.BYTE_BPE), f"file://{tmp_path}/e")).count() == 0


def test_network_gradients():
    rng = np.random.default_rng(0)
    d = langid.Direction.new(rng)
    for n in ("gate_in", "cand_in", "gate_h", "cand_h"):
        setattr(d, n, getattr(d, n).astype(np.float64))
    chunks = rng.integers(0, 256, (6, 3)).astype(np.uint8)
    weight = rng.normal(size=(6, 3, langid.HIDDEN))
    loss = lambda: float((np.stack(langid._run(d, chunks)[0]) * weight).sum())
    grads = langid._back(d, chunks, langid._run(d, chunks)[1], weight)
    for name, g in zip(("gate_in", "cand_in", "gate_h", "cand_h"), grads, strict=True):
        p = getattr(d, name)
        at = (int(chunks[2, 1]), 3) if name.endswith("_in") else (2, 5)
        keep = p[at]
        p[at] = keep + 1e-6
        up = loss()
        p[at] = keep - 1e-6
        down = loss()
        p[at] = keep
        assert g[at] == pytest.approx((up - down) / 2e-6, rel=1e-3, abs=1e-3)


def test_chunked_states_equal_the_training_pass():
    rng = np.random.default_rng(0)
    d = langid.Direction.new(rng)
    chunks = rng.integers(0, 256, (20, 4)).astype(np.uint8)
    assert np.allclose(d.states(chunks, np.full(20, 4), False), np.stack(langid._run(d, chunks)[0]), atol=1e-5)
    assert np.allclose(d.states(chunks, np.full(20, 4), True)[::-1], np.stack(langid._run(d, chunks[::-1])[0]), atol=1e-5)


def test_language_held_out_accuracy(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.identify(rows, langid.fit(rows)).join(rows.select(F.col("doc_id").alias("id"), "lang"), "id").where(F.crc32(F.col("id").cast("string")) % 5 == 0)
    r = found.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double")).alias("acc"), F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    assert r.acc > 0.96 and 0 <= r.lo and r.hi <= 1
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 ... !"), (4, "é"), (None, "the and of")], "doc_id bigint, text string")
    net = langid.train([b"the and of", "é è ê la les".encode()], ["en", "fr"], steps=30)
    got = {r.id: (r.lang_pred, r.score) for r in langid.identify(odd, net).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[4][0] in ("en", "fr")
    assert langid.train([], []).predict(["abc"]) == (["und"], [0.0])


def test_padding_and_order_do_not_matter():
    net = langid.train([b"the and of to in is", "é è ê la les des".encode()], ["en", "fr"], steps=30)
    texts = [b"the of", b"x" * 1000, "la les é ".encode() * 200, b""]
    together = net.probabilities(texts)
    for t, p in zip(texts, together, strict=True):
        assert net.probabilities([t])[0] == pytest.approx(p, abs=1e-5)


def test_learning_takes_bounded_rows_where_ids_repeat(spark, monkeypatch):
    """Rows that share an id are bounded like any others before they reach the driver."""
    seen = {}
    monkeypatch.setattr(quality, "train", lambda rows, y: seen.update(quality=len(rows)))
    monkeypatch.setattr(langid, "train", lambda parts, langs: seen.update(langid=len(parts)))
    rows = [(k % 3, f"some words {k}", "en") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(3)], "doc_id bigint, quality int")
    quality.fit(docs, labels, most_rows=5)
    langid.fit(docs, most_texts=2)
    assert 0 < seen["quality"] <= 5 and 0 < seen["langid"] <= 2 * langid.SEGMENTS_PER_TEXT


def test_sum_of_squares_identity():
    rng = np.random.default_rng(1)
    m = quality.Machine(0.3, rng.normal(size=quality.N_FEATURES).astype(np.float32), rng.normal(size=(quality.N_FEATURES, quality.FACTORS)).astype(np.float32))
    at, x = quality.features(b"some words and some more\nWORDS 123")
    plain = m.bias + float(m.linear[at] @ x) + sum(float(m.factors[at[i]] @ m.factors[at[j]] * x[i] * x[j]) for i in range(len(at)) for j in range(i + 1, len(at)))
    assert m.logit(at, x) == pytest.approx(plain, rel=1e-4)


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    m = quality.fit(docs, labels)
    held = labels.where(F.crc32(F.col("doc_id").cast("string")) % 5 == 0).select(F.col("doc_id").alias("id"), "quality")
    r = quality.score(docs, m).join(held, "id").agg(F.avg(((F.col("score") >= 0.3) == (F.col("quality") == 1)).cast("double")).alias("acc")).first()
    assert r.acc > 0.97
    odd = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (None, "x" * 100000, "c")], "doc_id bigint, text string, score string")
    assert all(0 <= r.score <= 1 for r in quality.score(odd, m).collect())
    assert quality.keep_quality(odd, m).columns == odd.columns
    none = quality.fit(docs, labels.where("false"))
    assert none.score(b"abc") == pytest.approx(0.5)


def test_blocks_of_a_file_are_coded_side_by_side(monkeypatch):
    """All blocks of a usual file move in one batch, and their bytes don't depend on the batches."""
    rng = np.random.default_rng(8)
    blocks = [rng.zipf(1.3, n).clip(0, 50_000).astype("<u4") for n in (3000, *[300] * 198, 7)]
    calls, code, decode = [], token_files._encode, token_files._decode
    monkeypatch.setattr(token_files, "_encode", lambda b: calls.append(len(b)) or code(b))
    monkeypatch.setattr(token_files, "_decode", lambda p, s: calls.append(len(p)) or decode(p, s))
    together = token_files.encode_blocks(blocks)
    got = token_files.decode_blocks(together, [len(b) for b in blocks])
    assert calls == [200, 200] and all((a == b).all() for a, b in zip(got, blocks, strict=True))
    monkeypatch.setattr(token_files, "CODED", 32)
    assert token_files.encode_blocks(blocks) == together


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("  \n\x85\xa0''stmdrevlS1²._é", max_size=12), max_size=5))
def test_latin_1_texts_are_split_at_once(texts):
    """The pieces of a slice come from array operations, as the pattern gives them; texts don't touch."""
    raw = [t.encode("latin-1") for t in texts]
    pieces, counts = bpe.byte_pieces(raw)
    expected = [bpe.BYTE_SPLIT[0].findall(t) for t in raw]
    assert pieces.to_pylist() == [p for own in expected for p in own] and counts.tolist() == list(map(len, expected))


def test_pieces_of_a_slice_are_looked_up_once_each(monkeypatch):
    """A slice's repeated pieces cost one look-up, whichever of its texts they are in; mixed slices keep their order."""
    tok, lib, asked = bpe.Bpe(bpe.vocabulary_path(bpe.BYTE_BPE), library=True), library(bpe.BYTE_BPE), []

    class Seen(dict):
        def get(self, piece):
            asked.append(piece)
            return dict.get(self, piece)

    tok.cached = Seen()
    list(tok.encode_slice(["one two two", "", "one two one"] * 50))
    assert sorted(asked) == [b" one", b" two", b"one"]
    mixed = [*ODD, "plain", "漢字 plain", "", "it's <|endoftext|>"] * 2
    assert [np.frombuffer(x, "<u4").tolist() for x in tok.encode_slice(mixed)] == [lib.encode(t, add_special_tokens=False).ids for t in mixed]


def test_coder_takes_streams_of_many_lengths_and_keeps_its_format():
    """Lanes are put in order of their lengths for each part; what is written stays as it was (CRC-32 of files of the version before)."""
    rng = np.random.default_rng(4)
    blocks = [rng.zipf(1.2, n).clip(0, 50_256).astype("<u4") for n in (5000, 1, 2047, 32768, 0, 4100)]
    coded = token_files.encode_blocks(blocks)
    assert zlib.crc32(b"".join(coded)) == 3760717890
    order = sorted(range(len(blocks)), key=lambda k: -len(blocks[k]))
    back = token_files.decode_blocks([coded[k] for k in order], [len(blocks[k]) for k in order])
    assert all((a == blocks[k]).all() for a, k in zip(back, order, strict=True))
    many = [rng.zipf(1.2, n).clip(0, 50_256).astype("<u4") for n in range(330, 30, -1)]
    assert all((a == b).all() for a, b in zip(token_files.decode_blocks(token_files.encode_blocks(many), list(map(len, many))), many, strict=True))


@given(st.lists(st.integers(0, 4), max_size=60))
def test_orders_equal_what_followed_last(ids):
    """The order-2 prediction by the hash of two ids, then the order-1 prediction, as a plain walk finds them."""
    ids, seen, expected, a, b = np.array(ids, np.uint16), {}, [], 0, 0
    for x in ids.tolist():
        two, one = (2, (a * int(token_files.M2) + b * int(token_files.M1)) & 0xFFFF), (1, b)
        expected.append(0 if seen.get(two) == x else 1 if seen.get(one) == x else 2)
        seen[two] = seen[one] = x
        a, b = b, x
    assert token_files.orders(ids).tolist() == expected


def test_documents_of_a_file_are_cut_where_they_are(tmp_path):
    """Documents of all sizes come back whole, and those before the end of a block don't move what follows them."""
    rng = np.random.default_rng(6)
    docs = [(k, rng.integers(0, 50_257, n).astype("<u4").tobytes()) for k, n in enumerate([1, 1, 40_000, 0, 3, 32_768, 70_000, *[2] * 500])]
    writer = token_files.TokenWriter(f"file://{tmp_path}/d.tok")
    for k, ids in docs:
        writer.add(k, ids)
    writer.close()
    assert list(token_files.TokenReader(f"file://{tmp_path}/d.tok").documents()) == docs
