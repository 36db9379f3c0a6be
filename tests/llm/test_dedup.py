"""Duplicates, repeats, archives and search against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from motionloom.llm import common, components, exact_dedup, jaccard, simhash, suffix_dedup, topk, warc


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    base = [" ".join("".join(rng.choice("abcdé") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(60, 150))) for _ in range(10)]
    out = [(k, b) for k, b in enumerate(base)]
    for k in range(10, 50):
        t = "".join(rng.choice("xyzé ") for _ in range(rng.randint(0, 300)))
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(base)
            a = rng.randrange(len(s))
            t += s[a : a + rng.randint(150, 420)] + "".join(rng.choice("uvw") for _ in range(rng.randint(0, 9)))
        out.append((k, t))
    near = base[1].split()
    near[7] = "changed"
    return out + [(60, None), (61, ""), (62, "a" * 1000), (63, "ab" * 300), (64, base[0]), (64, base[0]), (None, base[3]), (65, base[2].upper()), (66, "q" * 199), (67, "q" * 200), (68, "hello world this is line\n" * 20), (69, " ".join(near)), (70, "one two"), (71, "ONE\ttwo ")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "keep_id", "h") for i, t in rows], "doc_id bigint, text string, keep_id string, h string")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute_exact(rows, best):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[lower(t)] if x is not None]
        keep = best(ids) if ids else None
        out.append((i, keep, len(groups[lower(t)]), i == keep, hashlib.sha256(lower(t).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("keep,best", [("min", min), ("max", max)])
def test_exact(docs, rows, keep, best):
    assert sorted((tuple(r) for r in exact_dedup.exact_groups(docs, keep=keep).collect()), key=str) == brute_exact(rows, best)


def test_exact_survives_hash_collisions(docs, rows):
    got = exact_dedup.exact_groups(docs, keep="max", hash_fn=lambda t: F.length(t) % 2)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_exact(rows, max)


def test_exact_filter(docs):
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    left = [lower(r.text) for r in kept.collect()]
    assert set(left) == {lower(r.text) for r in docs.collect()}
    assert max(Counter(left).values()) == 1
    assert exact_dedup.exact_groups(docs.where("false")).count() == 0


@pytest.mark.parametrize("keep", ["min", "max"])
def test_exact_filter_keeps_one_of_equal_and_null_ids(spark, keep):
    rows = [(5, "A b", 3), (5, "a b", 1), (5, "a b", 1), (None, "a b", 0), (None, "alone", 2), (None, "Alone", 2), (None, "alone", 1), (5, "other", 1), (None, None, 1), (None, "", 1), (7, "a b", 9), (7, "a b", 9)]
    got = exact_dedup.drop_exact_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string, n int"), keep=keep).collect()
    assert sorted((lower(r.text), r.doc_id) for r in got if r.doc_id) == [("a b", 5 if keep == "min" else 7), ("other", 5)]
    assert sorted(lower(r.text) for r in got if r.doc_id is None) == ["", "alone"]


def test_near_filter_keeps_one_of_equal_and_null_ids(spark):
    rows = [(9, "p q r s"), (9, "p q r s"), (None, "p q r s"), (None, "one two three"), (None, "one two three"), (3, "far away from it all"), (3, "far away from it all")]
    got = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(map(tuple, got), key=str) == [(3, "far away from it all"), (9, "p q r s"), (None, "one two three")]


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def test_simhash(docs, rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(i):
                if (fps[i] ^ fps[j]).bit_count() <= 3:
                    root[i] = root[j] = min(root[i], root[j])
    low = {r: min((rows[i][0] for i in range(len(rows)) if root[i] == r and rows[i][0] is not None), default=None) for r in root}
    expected = sorted(((rows[i][0], f"{fps[i]:016x}", low[root[i]]) for i in range(len(rows))), key=str)
    assert sorted((tuple(r) for r in simhash.simhash_components(docs).collect()), key=str) == expected
    kept = simhash.drop_near_duplicates(docs.where("doc_id IS NOT NULL"))
    assert kept.columns == docs.columns
    assert simhash.simhash_components(docs.where("false")).count() == 0


def brute_sets(texts):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        out.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))})
    return out


def brute_near(rows):
    """Rows that stay: of each component over Jaccard >= 0.8 the smallest id, then the smallest hash of the text."""
    sets, root = brute_sets([t for _, t in rows]), list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) and root[i] != root[j]:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    groups = defaultdict(list)
    for r, (i, t) in zip(root, rows, strict=True):
        groups[r].append((i is None, i or 0, hashlib.sha256((t or "").encode()).hexdigest(), (i, t)))
    return sorted((min(g)[3] for g in groups.values()), key=str)


def test_near_pairs_of_every_similarity(spark, rows, monkeypatch):
    """Copies with more and more words changed, families whose first member is not like all others, equal and null ids."""
    rng = random.Random(12)
    out = [(i, t) for i, t in rows]
    for f in range(12):
        base = [f"w{rng.randrange(10**6)}" for _ in range(100 + f)]
        for k in range(14):
            words = list(base)
            for at in rng.sample(range(len(base)), k % 7):
                words[at] = f"x{rng.randrange(10**6)}"
            out.append((None if k == 9 else 1000 * f + rng.randrange(900), " ".join(words[rng.randrange(3) : len(words) - rng.randrange(4)])))
    boiler = " ".join(f"license{k}" for k in range(40))
    out += [(50_000 + k, boiler + " " + " ".join(f"own{k}x{j}" for j in range(k % 60))) for k in range(60)]
    # exactly 0.8 (20 shingles, 16 shared of 20), and just below
    line = [f"e{k}" for k in range(24)]
    out += [(60_000, " ".join(line)), (60_001, " ".join(line[:20])), (60_002, " ".join(line[5:]))]
    expected = brute_near(out)
    df = spark.createDataFrame(out, "doc_id bigint, text string").repartition(3)
    for common in (3, 10**9):
        monkeypatch.setattr(jaccard, "COMMON_IN_SAMPLE", common)
        assert sorted(map(tuple, simhash.drop_near_duplicates(df, balls_first=common == 3).collect()), key=str) == expected
    assert len(expected) < len(out) - 60 and (60_001, " ".join(line[:20])) not in expected
    assert simhash.drop_near_duplicates(df.where("false")).count() == 0


def test_long_text_in_steps():
    text = " ".join(f"w{k % 997}" for k in range(3000)).encode()
    assert simhash.fingerprint(text) == simhash.fingerprint(text, step=255 * 3) == brute_fingerprint(text.decode())


@pytest.mark.parametrize("k", [0, 3])
def test_ball_links_miss_nothing_and_invent_nothing(k):
    rng = np.random.default_rng(1)
    fps = [int(x) for x in rng.integers(0, 2**63, 120)] + [0, 1, 3, 7, 15]
    for x in list(fps):
        for _ in range(4):
            y = x
            for b in rng.choice(64, rng.integers(1, 5), replace=False):
                y ^= 1 << int(b)
            fps.append(y)
    fps = np.unique(np.array(fps, np.uint64))
    true = components.local_roots(len(fps), *np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3))
    at = {int(x): i for i, x in enumerate(fps)}
    a, b = [], []
    for bucket in range(64 << k):
        x, y = simhash.bucket_links(fps, bucket, k)
        a += [at[int(v)] for v in x]
        b += [at[int(v)] for v in y]
    assert (components.local_roots(len(fps), np.array(a), np.array(b)) == true).all()


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (101, 100), (7, 7)] + [(200, x) for x in range(201, 260)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100, 102: 100, **{x: 200 for x in range(201, 260)}}
    assert components.connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def brute_repeats(rows, depth):
    seen, texts = Counter(), [(i, (t or "").encode()) for i, t in rows]
    for _, t in texts:
        seen.update(t[p : p + depth] for p in range(len(t) - depth + 1))
    out = []
    for i, t in texts:
        mask = bytearray(len(t))
        for p in range(len(t) - depth + 1):
            if seen[t[p : p + depth]] > 1:
                mask[p : p + depth] = b"\1" * depth
        kept = bytes(b for b, m in zip(t, mask, strict=True) if not m)
        out.append((i, len(t), sum(mask), sum(1 for k in range(len(mask)) if mask[k] and (k == 0 or not mask[k - 1])), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [5000, 1])
def test_repeated_windows(docs, rows, hot):
    assert sorted((tuple(r) for r in suffix_dedup.removal(docs, hot=hot).collect()), key=str) == brute_repeats(rows, 200)


def test_sections_of_long_texts(rows):
    text = "".join((t or "") for _, t in rows).encode()
    whole = [np.concatenate(c) for c in zip(*suffix_dedup.runs_of(text), strict=True)]
    cut = [np.concatenate(c) for c in zip(*suffix_dedup.runs_of(text, section=700), strict=True)]
    spread = lambda r: np.repeat(r[0], r[4])
    assert (spread(whole) == spread(cut)).all() and cut[4].sum() == len(text) - 199


def test_removed_text(docs, rows):
    kept = suffix_dedup.remove_repeats(docs.withColumn("n_chars", F.length("text").cast("bigint")))
    assert kept.columns == [*docs.columns, "n_chars"] and kept.count() == len(rows)
    got = {r.doc_id: r for r in kept.collect()}
    assert got[62].text == "" and got[62].n_chars == 0 and got[60].text is None and got[66].text == "q" * 199


def test_archives(spark, tmp_path):
    html = "<p>" + "é" * 100
    pages = spark.createDataFrame([(1, "http://a/ b\r\n", html, "x"), (2, None, html, "x"), (2, "u", html, "x"), (3, "u", "short", "x"), (4, "u", "short", "x"), (5, "u", None, "x"), (None, "u", html, "x"), (6, "u", "y" * 700_000, "x"), (1, "u", html, "x")], "page_id bigint, url string, html string, digest string")
    index = warc.write(warc.with_types(pages), f"file://{tmp_path}/w", frame_bytes=300)
    got = warc.read(index.select("file").distinct()).collect()
    assert len(got) == 9
    for r in got:
        text = {1: html, 2: html, None: html, 3: "short", 4: "short", 5: "", 6: "y" * 700_000}[r.page_id].encode()
        revisit = text == html.encode() and r.page_id != 1
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == (len(text), hashlib.sha256(text).hexdigest(), "revisit" if revisit else "response", 1 if revisit else None)
        assert revisit or r.payload == text
    for r in index.collect():
        headers, _ = warc.read_record(r.file, r.frame, r.frame_offset)
        assert warc.page_of(headers["WARC-Record-ID"]) == r.page_id and headers["WARC-Type"] == r.record_type
    import zstandard

    path = index.first().file.removeprefix("file://")
    with open(path, "rb") as f:  # any reader of the format can read it front to back
        plain = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
    assert plain.startswith(b"WARC/1.1")
    empty = warc.write(warc.with_types(pages.where("false")), f"file://{tmp_path}/e")
    assert warc.read(empty.select("file").distinct()).count() == 0


def test_damaged_frame(tmp_path):
    w = warc.BundleWriter(f"file://{tmp_path}/x", 10)
    for k in range(3):
        w.add(warc.record(k, "u", b"payload" * 50))
    w.close()
    raw = bytearray((tmp_path / "x").read_bytes())
    raw[40] ^= 255
    (tmp_path / "x").write_bytes(raw)
    with pytest.raises(Exception):
        warc.BundleReader(f"file://{tmp_path}/x").frame(0)


@pytest.mark.parametrize("scale", [3, 1_000_000_000])
def test_search(scale):
    rng = np.random.default_rng(3)
    c = rng.integers(-scale, scale + 1, (700, 6))
    ids = rng.permutation(700)
    q, q_ids = c[:40], ids[:40]
    at, got, score = topk.search(q_ids, q, ids, c, 20, block=32)
    for k in range(40):
        best = sorted((-int(s), int(i)) for s, i in zip((c.astype(object) @ q[k].astype(object)), ids, strict=True) if i != q_ids[k])[:20]
        assert [(-int(s), int(i)) for s, i in zip(score[at == k], got[at == k], strict=True)] == best


def test_top_k_table(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_VALUES", 40)
    monkeypatch.setattr(topk, "GROUP_VALUES", 8)
    rng = np.random.default_rng(1)
    vec = {i: rng.normal(size=4).astype(np.float32).tolist() for i in range(60)}
    vec |= {60: vec[3], 61: None, 62: [1.0, None, 0.0, 0.0], 63: [float("nan")] * 4, 64: [float("inf")] * 4, 80: [0.5, 0.5]}
    rows = [(i, v, "score") for i, v in vec.items()] + [(20, vec[20], "again"), (None, vec[1], "x")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, id string")
    got = topk.top_k(topk.quantised(df), F.col("id") % 20 == 0, 5).collect()
    ints = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v] + [0] * (4 - len(v))) for i, v, _ in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    for q in {i for i, _ in ints if i % 20 == 0}:
        own = next(v for i, v in ints if i == q)
        best = sorted((-sum(a * b for a, b in zip(own, v, strict=True)), i) for i, v in ints if i != q)[:5]
        assert [(-r.score, r.vec_id) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] == best
    assert topk.top_k(topk.quantised(df.where("false")), F.col("id") % 20 == 0).count() == 0


def test_scores_beyond_64_bits_stop():
    ids = np.arange(2)
    big = np.array([[1 << 40, 0], [0, 1 << 40]])
    with pytest.raises(ValueError, match="64 bits"):
        topk.search(ids, big, ids, big, 1)


@pytest.mark.parametrize("x", [1e300, -1e300, 1e18])
def test_components_beyond_64_bits_stop(spark, x):
    df = spark.createDataFrame([(0, [x, 1.0]), (1, [float("inf"), 1.0])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="does not fit in 64 bits"):
        topk.quantised(df).collect()


def test_sketches_never_rule_out_similar_sets():
    rng = np.random.default_rng(3)
    ruled_out = 0
    for n in (1, 5, 60, 64, 65, 700, 5000):
        base = rng.integers(0, 2**63, n).astype(np.uint64)
        for change in np.linspace(0, 1, 12):
            k = int(n * change)
            other = np.unique(np.concatenate((base[k:], rng.integers(0, 2**63, k).astype(np.uint64))))
            own = np.unique(base)
            alike = jaccard.similar(len(np.intersect1d(own, other)), len(own), len(other))
            may = jaccard.may_be_similar(jaccard.sketch(own), jaccard.sketch(other))
            assert may or not alike
            ruled_out += not may
    assert ruled_out > 40


def test_pairs_on_one_shared_shingle_are_linear(spark, monkeypatch):
    """Texts that are alike in one shingle only, and families among them: few pairs are compared, and every link is found."""
    monkeypatch.setattr(jaccard, "COMMON_IN_SAMPLE", 10**9)  # so that the shared shingle stands anywhere in the order
    seen = []
    verified = jaccard._verified
    monkeypatch.setattr(jaccard, "_verified", lambda pairs, *a, **k: seen.append(pairs.count()) or verified(pairs, *a, **k))
    rng = random.Random(4)
    shared = "one two three four five"
    rows = [(k, shared + " " + " ".join(f"own{k}x{j}" for j in range(9))) for k in range(300)]
    got = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert got.count() == 300 and sum(seen) <= 3 * 300
    # families over one passage: apart in the hub's eyes, alike among themselves
    passage = [f"p{j}" for j in range(12)]
    more = []
    for f in range(30):
        base = passage + [f"f{f}x{j}" for j in range(30)]
        more += [(1000 + 10 * f + k, " ".join(base + [f"tail{f}x{k}"] * (k % 3))) for k in range(rng.randint(1, 6))]
    assert sorted((tuple(r) for r in simhash.drop_near_duplicates(spark.createDataFrame(rows[:40] + more, "doc_id bigint, text string")).collect()), key=str) == brute_near(rows[:40] + more)


def test_numbers_of_joined_and_exploded_rows(spark, tmp_path):
    words = " ".join(f"w{k}" for k in range(30))
    spark.createDataFrame([(1, words), (2, "other " + words[::-1])], "doc_id bigint, text string").write.parquet(f"{tmp_path}/t")
    docs = spark.read.parquet(f"{tmp_path}/t")
    exploded = docs.withColumn("k", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    assert simhash.drop_near_duplicates(exploded).count() == 2
    other = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "i bigint, x string")
    assert sorted(r.doc_id for r in simhash.drop_near_duplicates(docs.join(other, F.col("doc_id") == F.col("i"))).collect()) == [1, 2]
    assert simhash.drop_near_duplicates(docs.unionAll(docs)).count() == 2


@pytest.mark.parametrize("name", ["__node", "node", "__gone", "gone", "__file", "file", "row", "file_name", "file_first", "__row", "NODE", "grp", "__i", "__t", "__spans", "cut_at", "spans", "i", "t", "a", "b"])
def test_columns_of_any_name_pass_through(spark, tmp_path_factory, name):
    path = tmp_path_factory.mktemp("named")
    text = "x" * 250
    spark.createDataFrame([(1, text + "a", "one"), (2, text + "b", "two"), (3, "c d e f g h", "three")], f"doc_id bigint, text string, `{name}` string").write.parquet(f"{path}/t")
    docs = spark.read.parquet(f"{path}/t")
    kept = suffix_dedup.remove_repeats(docs, length_col=None)
    assert kept.columns == docs.columns and sorted(r[2] for r in kept.collect()) == ["one", "three", "two"]
    from motionloom.llm.common import keep_one, numbered

    rows, node = numbered(docs)
    members = rows.where("doc_id < 3").select(F.col(f"`{node}`").alias("node"), F.lit(7).alias("grp"))
    assert sorted(r[2] for r in keep_one(rows, node, members, "doc_id", "text").collect()) == ["one", "three"]


def test_batch_size_of_the_session_stays(spark, docs):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    simhash.drop_near_duplicates(docs).count()
    suffix_dedup.removal(docs).count()
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


@pytest.mark.parametrize("block", [7, 500_000])
def test_components_in_blocks(spark, monkeypatch, block):
    """Chains, stars and rings that several blocks share, and what one block holds."""
    monkeypatch.setattr(components, "BLOCK", block)
    rng = random.Random(block)
    links = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)] + [(1000 + i, 1001 + i) for i in range(25)] + [(2000, 2000 + i) for i in range(1, 20)]
    rng.shuffle(links)
    nodes = sorted({x for link in links for x in link})
    at = {x: k for k, x in enumerate(nodes)}
    root = components.local_roots(len(nodes), np.array([at[a] for a, _ in links]), np.array([at[b] for _, b in links]))
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {x: nodes[r] for x, r in zip(nodes, root.tolist(), strict=True) if nodes[r] != x}


def test_near_stage_takes_pairs_from_the_fingerprints(spark, monkeypatch):
    """The balls of the fingerprints give the stage pairs, and what they miss comes from the join."""
    import corpus_pipeline

    rng = random.Random(5)
    base = [[f"w{rng.randrange(10**6)}" for _ in range(150)] for _ in range(20)]
    rows = [(10 * k, " ".join(w)) for k, w in enumerate(base)] + [(10 * k + 1, " ".join([*w[:149], "other"])) for k, w in enumerate(base)] + [(10 * k + 2, " ".join([*w[:140], *(f"x{j}" for j in range(10))])) for k, w in enumerate(base)]
    pairs, balls = [], simhash.ball_pairs
    monkeypatch.setattr(simhash, "ball_pairs", lambda *a, **k: pairs.append(got := balls(*a, **k)) or got)
    kept = corpus_pipeline.near_stage(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), "")
    assert sorted(map(tuple, kept.collect()), key=str) == brute_near(rows) and len(brute_near(rows)) == 20
    assert 5 <= pairs[0].count() < 60


def test_common_shingles_are_counted_over_all_texts(spark, tmp_path):
    """A passage of few texts among very many others is known as common, so texts that share no more than it are not compared."""
    rows = [(k, " ".join(f"p{k % 40}x{j}" for j in range(12)) + " " + " ".join(f"own{k}x{j}" for j in range(60))) for k in range(800)]
    docs = spark.createDataFrame([(k, t) for k, t in rows], "node bigint, text string")
    with jaccard.Scratch(spark, "test") as tables:
        order = jaccard._common(docs, 800 * 70, tables)
    sets = [jaccard.shingles(t.encode()) for _, t in rows]
    shared = np.unique(np.concatenate(sets), return_counts=True)
    assert len(order.keys) == int((shared[1] > jaccard.SMALL).sum()) == 40 * 8
    assert all(not (order.ranks(jaccard.prefix(s, order)) > 0).any() for s in sets)


def test_copies_with_changes_of_their_own_are_compared_by_these(spark, monkeypatch):
    """Copies of one text that is not there, each with three changes and so unlike all others, and copies of some of these."""
    seen = []
    verified = jaccard._verified
    monkeypatch.setattr(jaccard, "_verified", lambda pairs, *a, **k: seen.append(pairs.count()) or verified(pairs, *a, **k))
    rng = random.Random(7)
    base, rows = [f"w{j}" for j in range(150)], []
    for k in range(200):
        words = list(base)
        for at in rng.sample(range(12), 1) + rng.sample(range(30, 140), 2):
            words[at] = f"own{k}x{at}"
        rows.append((k, " ".join(words)))
        if k % 10 == 0:
            rows.append((1000 + k, " ".join([*words[:-1], f"end{k}"])))
    got = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute_near(rows)
    assert sum(seen) <= 20 * len(rows)
    counts = {}
    for text in rows:
        for x in jaccard.shingles(text[1].encode()).tolist():
            counts[x] = counts.get(x, 0) + 1
    assert sum(n > 8 for n in counts.values()) > 100


def test_small_batches_bound_bytes(spark):
    """Long texts go to Python a few at a time, though their rows are fewer than a batch may have."""
    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64()), pa.array([b.nbytes], pa.int64())], names=["rows", "bytes"])

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    texts = spark.range(0, 300, 1, 1).select(F.expr("repeat('0123456789', 10000)").alias("text"))
    with common.small_batches(spark):
        got = texts.mapInArrow(sizes, "rows bigint, bytes bigint").collect()
    assert sum(r["rows"] for r in got) == 300 and max(r["bytes"] for r in got) < 6 << 20
    assert spark.conf.get(name, None) is None
    with common.settings(spark, {name: "1000"}), common.small_batches(spark):
        assert spark.conf.get(name) == "1000"  # a smaller bound stays


def test_lean_tasks_drop_what_others_keep(spark):
    """A worker that served a tokenizer keeps none of its tables in a near-duplicate task."""
    def keep(batches):
        from motionloom.llm.common import kept

        for b in batches:
            kept["of another operator"] = bytes(1000)
            yield b

    def left(batches):
        from motionloom.llm.common import kept

        for b in batches:
            yield b.slice(0, len(kept))

    one = spark.range(0, 1, 1, 1)
    one.mapInArrow(keep, "id bigint").collect()
    assert one.mapInArrow(common.lean(left), "id bigint").collect() == []
    common.kept["here"] = 1
    assert common.lean_groups(lambda key, got: dict(common.kept))(None, None) == {}
    assert list(common.lean(lambda batches: batches)(iter([1, 2]))) == [1, 2]


def test_texts_that_share_usual_words_only_are_not_compared(spark, monkeypatch):
    """Usual words side by side, by chance alike in too few texts to be common: no pair comes from them."""
    seen = []
    verified = jaccard._verified
    monkeypatch.setattr(jaccard, "_verified", lambda pairs, *a, **k: seen.append(pairs.count()) or verified(pairs, *a, **k))
    rng = random.Random(9)
    rows = [(k, " ".join(" ".join([*(f"u{rng.randrange(7)}" for _ in range(6)), *(f"own{k}x{j}x{i}" for i in range(3))]) for j in range(12))) for k in range(400)]
    shared = np.unique(np.concatenate([jaccard.shingles(t.encode()) for _, t in rows]), return_counts=True)[1]
    assert (shared > 1).sum() > 1000 and shared.max() <= jaccard.SMALL
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert kept.count() == 400 and sum(seen) == 0


def test_order_of_common_shingles(spark, monkeypatch):
    """More than half a million are known, in five bytes each, rarer ones first; of too many the most common."""
    keys = spark.range(600_000).select(F.xxhash64("id").alias("key"), (F.col("id") % 50 + 9).alias("n"))
    order = jaccard.Order(*jaccard._most(keys))
    known = np.unique(keys.select("key").toPandas()["key"].to_numpy().view(np.uint64) >> np.uint64(32))
    assert np.array_equal(order.keys, known) and order.keys.nbytes + order.levels.nbytes == 5 * len(known)
    monkeypatch.setattr(jaccard, "MOST_COMMON", 100_000)
    fewer, levels = jaccard._most(keys)
    assert 90_000 < len(fewer) < 110_000 and levels.min() > order.levels.min()
    own = np.array([5, 6, 7, 8], np.uint64) << np.uint64(40)
    first = jaccard.Order((jaccard.keys_of(own[:2]) >> np.uint64(32)).astype(np.uint32), np.array([9, 1], np.uint8))
    both = first.after((jaccard.keys_of(own[2:3]) >> np.uint64(32)).astype(np.uint32), np.array([255], np.uint8))
    assert own[np.argsort(both.ranks(own), kind="stable")].tolist() == own[[3, 2, 1, 0]].tolist()


def test_heaps_are_collected(spark):
    counts = lambda: sum(b.getCollectionCount() for b in spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans())
    before = counts()
    common.shrink_heaps(spark)
    assert counts() > before
