"""Near duplicates by exact Jaccard similarity of word shingles: a prefix-filtered similarity join, and components.

Sets: the distinct 64-bit hashes of a text's five-word shingles (ASCII white space; A-Z lower-cased). A text with fewer words is one
shingle; texts without words all share one shingle.

Candidates: shingles have one order for all texts (common ones last, by their number of texts, then by value). Two sets of
similarity s or more share a shingle among the first n - ceil(s n) + 1 of either, so that only these prefixes are dealt into
buckets and compared; no pair is missed. Which shingles are common is counted over all texts, by 37 or more bits of each. The
upper six bits of a value say how probable five such words are side by side, by counts of words over all texts, so that shingles of
rare words come first: five usual words meet by chance in any two texts, and those pairs would grow with the square of the texts.
Both decide the cost only, not the result. Sets are kept only of texts that share a prefix shingle or are a seed, and all later
rounds read these.

Groups: in a group of texts that share a prefix shingle, each is first compared with one of them, the hub; a group whose
shingle is common is dealt out in slices, each with a hub of its own. In groups that then still hold several components,
one member of each component is compared with one of the group's largest, in two turns with different members. What is still
apart is compared pair by pair in groups of at most SMALL members. The shingles that the members of larger groups share become common ones, and these members,
and no others, get new prefixes: a similar pair not found by then has both its texts in such groups only, and shares a shingle of
the new prefixes as well. This goes on until no group is large, so the pairs are linear in the entries, and none is
missed. Texts that then still share a group, since they hold too few other shingles for a prefix without common ones, are described by
their differences from a pivot, the first text of their group's largest component: copies of one text with a few changes each share
most shingles, but few differences. |x ^ y| follows from the differences dx = x ^ p and dy = y ^ p, as |dx| + |dy| - 2 |dx & dy|, so
that similar texts share one of their rarest differences, or both are similar to the pivot. Only texts that share those are compared.
A pair is first judged by two small sketches, which rule out most pairs and never a similar one, and then verified by
intersecting the two sets.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motionloom.llm.common import Scratch, apart, as_bytes, cut, lean, lean_groups, release, shrink_heaps, text_slices
from motionloom.llm.components import connected_components

WORDS = 5
#: Similarity as a fraction of whole numbers, so that the border is exact.
NUM, DEN = 4, 5
#: Members of a group that are compared pair by pair: at most three and a half pairs for each.
SMALL = 8
#: Texts with a shingle from which on it is common, and how many common ones the tasks get at most, the most common first (five
#: bytes each; more than 13 GB of documents like those of check_l hold, by their number there).
COMMON_IN_SAMPLE, MOST_COMMON = SMALL + 1, 1 << 22
BUCKET_ENTRIES, LEAST_BUCKETS = 300_000, 24
#: Shingles that are counted in one bucket, about.
COUNTED = 1 << 20
#: Rounds in which components of a group are compared by single members, before all that is left is.
TURNS = 2
#: Words are counted by as many bits of their hash; and the bits of a shingle below those of its words' probability.
WORD_BITS, VALUE_BITS = 20, 58
ENTRY = np.dtype([("s", "<u8"), ("node", "<i8"), ("size", "<i4")])


def word_places(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64((1 << WORD_BITS) - 1)).astype(np.int64)


def shingles(text: bytes, words_per_shingle: int = WORDS, usual: np.ndarray | None = None) -> np.ndarray:
    """Distinct hashes, ascending. Never empty. usual: as from usual_words(); then those of rare words have smaller values."""
    words = text.lower().split()
    digest = xxhash.xxh64_intdigest
    w = np.fromiter((digest(x, 42) for x in words), np.uint64, len(words)) if words else np.zeros(1, np.uint64)
    k = min(words_per_shingle, len(w))
    out = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        out = (out ^ w[i : len(w) - k + 1 + i]) * np.uint64(0x9E3779B185EBCA87)
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xC2B2AE3D27D4EB4F)
    out ^= out >> np.uint64(32)
    if usual is not None:
        bits, each = np.zeros(len(out), np.int64), usual[word_places(w)]
        for i in range(k):
            bits += each[i : len(w) - k + 1 + i]
        often = np.clip((1 << 64 - VALUE_BITS) - 1 + (bits >> 2), 0, None).astype(np.uint64)
        out = (out & np.uint64((1 << VALUE_BITS) - 1)) | (often << np.uint64(VALUE_BITS))
    return np.unique(out)


def keys_of(own: np.ndarray) -> np.ndarray:
    """The bits of shingles that their words' probability leaves, from the highest bit on."""
    return own << np.uint64(64 - VALUE_BITS)


def usual_words(rows: DataFrame, tables: Scratch) -> np.ndarray:
    """By a place for each value of WORD_BITS bits of a word's hash: four times the binary logarithm of the share that the words there
    have of all words of the texts (node, text), -127 or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << WORD_BITS, np.int64)
        for b in text_slices(batches, 4 << 20):
            n = Counter(b" ".join(as_bytes(b.column("text"))).lower().split())
            hashes = np.fromiter((xxhash.xxh64_intdigest(x, 42) for x in n), np.uint64, len(n))
            np.add.at(counts, word_places(hashes), np.fromiter(n.values(), np.int64, len(n)))
        used = np.flatnonzero(counts)
        for at in range(0, len(used), 1 << 16):
            some = used[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some])], names=["place", "n"])

    sums = rows.select("text").mapInArrow(lean(run), "place int, n bigint").groupBy("place").agg(F.sum("n").alias("n"))
    found = tables.keep(sums).toArrow()
    n = found.column("n").to_numpy()
    usual = np.full(1 << WORD_BITS, -127, np.int8)
    usual[found.column("place").to_numpy()] = np.maximum(np.rint(4 * np.log2(n / max(1, n.sum()))), -127)
    return usual


class Order:
    """The order of shingles: common ones come last, by their levels. Others, and those of a level, by value.

    A common shingle is known by 32 bits; the few others that share them are taken for common as well."""

    def __init__(self, keys: np.ndarray, levels: np.ndarray):
        """keys: uint32; levels: from 1 on, higher for more texts."""
        at = np.lexsort((levels, keys))
        keys, levels = keys[at], levels[at]
        last = np.append(keys[1:] != keys[:-1], True) if len(keys) else np.zeros(0, bool)
        self.keys, self.levels = keys[last], levels[last]

    def ranks(self, own: np.ndarray) -> np.ndarray:
        """0 for shingles that aren't common; common ones from 1 on."""
        if not len(self.keys):
            return np.zeros(len(own), np.int32)
        key = (keys_of(own) >> np.uint64(32)).astype(np.uint32)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.levels[at], 0)

    def after(self, keys: np.ndarray, levels: np.ndarray) -> Order:
        """The order in which these, which weren't common, come between the others and the common ones."""
        above = self.levels.astype(np.uint16) + int(levels.max(initial=0))
        return Order(np.concatenate([keys, self.keys]), np.concatenate([levels.astype(np.uint16), above]))


def prefix(own: np.ndarray, order: Order) -> np.ndarray:
    """The shingles of which two similar sets share one, common ones last. own: ascending."""
    n = len(own)
    return own[np.argsort(order.ranks(own), kind="stable")[: n - -(-NUM * n // DEN) + 1]]


def similar_sizes(a, b):
    """Whether sets of these sizes can be similar enough."""
    return (a * DEN >= b * NUM) & (b * DEN >= a * NUM)


def similar(both: int, a: int, b: int) -> bool:
    return both * (NUM + DEN) >= NUM * (a + b)


def sketch(own: np.ndarray) -> bytes:
    """The size of a set, and the parities of its members in a power of two of places, about one place a member."""
    places = 1 << min(16, max(6, (len(own) - 1).bit_length()))
    odd = np.bincount((own >> np.uint64(40)).astype(np.int64) & (places - 1), minlength=places) & 1
    return len(own).to_bytes(4, "little") + np.packbits(odd, bitorder="little").tobytes()


def may_be_similar(x: bytes, y: bytes) -> bool:
    """From two sketches: false only if the sets are not similar. Each place of unequal parity holds a member of one set
    alone, and sets of similarity s have at most (1 - s) / (1 + s) of their joint size of those."""
    a, b = int.from_bytes(x[:4], "little"), int.from_bytes(y[:4], "little")
    n = min(len(x), len(y)) - 4
    p, q = (np.bitwise_xor.reduce(np.frombuffer(z, np.uint8, offset=4).reshape(-1, n), axis=0) for z in (x, y))
    return int(np.bitwise_count(p ^ q).sum()) * (DEN + NUM) <= (a + b) * (DEN - NUM)


def meet(entries: np.ndarray, order: Order) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries of one bucket -> pairs of each group's first node with the others (a, b), and the entries of groups that may have
    more pairs: of three and more, and those whose shingle is common, since its other slices are elsewhere."""
    entries = entries[np.lexsort((entries["node"], entries["s"]))]
    first = np.concatenate(([True], entries["s"][1:] != entries["s"][:-1])) if len(entries) else np.zeros(0, bool)
    starts = np.flatnonzero(first)
    counts = np.diff(np.append(starts, len(entries)))
    hub = entries[np.repeat(starts, counts)]
    pair = ~first & similar_sizes(entries["size"].astype(np.int64), hub["size"].astype(np.int64))
    pairs = np.unique(np.stack([hub["node"][pair], entries["node"][pair]], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1], entries[(np.repeat(counts, counts) >= 3) | (order.ranks(entries["s"]) > 0)]


def _common(rows: DataFrame, entries: int, tables: Scratch) -> Order:
    """Counts the texts (node, text) that hold each shingle; entries: about how many shingles all texts have. A shingle is
    known by the upper bits of its key here: those of its bucket and 32 more, so that few bytes are sent."""
    bits = min(24, max(5, (entries // COUNTED).bit_length()))
    shift, borders = np.uint64(32 - bits), np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(32)
    least = COMMON_IN_SAMPLE

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, 4 << 20):
            keys, n = np.unique(keys_of(np.concatenate([shingles(t) for t in as_bytes(b.column("text"))])) >> shift, return_counts=True)
            ends = np.searchsorted(keys, borders)
            keys, once = keys.astype("<u4"), n == 1
            buckets, ones, more = [], [], []
            for k in np.flatnonzero(np.diff(ends)):
                at = slice(ends[k], ends[k + 1])
                part, one = keys[at], once[at]
                buckets.append(k)
                ones.append(part[one].tobytes())
                more.append(np.stack([part[~one], n[at][~one].astype("<u4")], axis=1).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), pa.array(ones, pa.binary()), pa.array(more, pa.binary())], names=["bucket", "ones", "more"])

    def count(key: tuple, got: pa.Table) -> pa.Table:
        ones = np.frombuffer(b"".join(got.column("ones").to_pylist()), "<u4")
        more = np.frombuffer(b"".join(got.column("more").to_pylist()), "<u4").reshape(-1, 2)
        every, times = np.concatenate([ones, more[:, 0]]), np.concatenate([np.ones(len(ones), np.int64), more[:, 1]])
        at = np.argsort(every)
        every = every[at]
        first = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
        n = np.add.reduceat(times[at], first)
        often = n >= least
        keys = (every[first][often].astype(np.uint64) | np.uint64(key[0].as_py() << 32)) << shift
        return pa.table({"key": keys.view(np.int64), "n": n[often].astype(np.int64)})

    sent = rows.select("text").mapInArrow(lean(send), "bucket bigint, ones binary, more binary")
    return Order(*_most(tables.keep(sent.groupBy("bucket").applyInArrow(lean_groups(count), "key bigint, n bigint"))))


def _most(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """key (as of keys_of), n -> the upper 32 bits of the keys of the largest n, about MOST_COMMON at most, and their levels: eight for
    each doubling of n. Of a level that finds room in part, those with the smallest keys."""
    level = F.least(F.lit(255), F.floor(8 * F.log2("n")) + 1).cast("int")
    known = counted.select(F.shiftright("key", 32).cast("int").alias("key"), level.alias("level"))
    room, least, share = MOST_COMMON, 0, 1.0
    for r in sorted(known.groupBy("level").count().collect(), reverse=True):
        if r["count"] > room:
            least, share = r["level"], room / r["count"]
            break
        room -= r["count"]
    taken = known.where((F.col("level") > least) | ((F.col("level") == least) & (F.col("key") < int(share * 2**32) - 2**31)))
    top = taken.select("key", F.col("level").cast("smallint")).toArrow()
    return top.column("key").to_numpy().view(np.uint32), top.column("level").to_numpy().astype(np.uint8)


def _sets(rows: DataFrame, usual) -> DataFrame:
    """node, own (the shingles' bytes, ascending), sketch of rows (node, text). usual: broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, 1 << 20):
            own = [shingles(t, usual=usual.value) for t in as_bytes(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array([x.tobytes() for x in own], pa.binary()), pa.array([sketch(x) for x in own], pa.binary())], names=["node", "own", "sketch"])

    return rows.select("node", "text").mapInArrow(lean(run), "node bigint, own binary, sketch binary")


def _verified(pairs: DataFrame, sets: DataFrame, sifted: bool = False) -> DataFrame:
    """Those of the pairs (a, b, distinct) that are similar; sets: as from _sets. sifted: judge all pairs by sketches first,
    which pays where most are not similar."""

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [may_be_similar(x, y) for x, y in zip(b.column("own_a").to_pylist(), b.column("own_b").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("own_a"), b.column("own_b"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                keep.append(similar(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # merge joins by hint here and below: the many small broadcasts of a run would pile up in the driver
    def beside(of: DataFrame, column: str) -> DataFrame:
        first = of.join(sets.select(F.col("node").alias("na"), F.col(column).alias("own_a")).hint("merge"), F.col("a") == F.col("na")).select("a", "b", "own_a")
        return first.join(sets.select(F.col("node").alias("nb"), F.col(column).alias("own_b")).hint("merge"), F.col("b") == F.col("nb")).select("a", "b", "own_a", "own_b")

    near = pairs
    if sifted:  # sketches are a sixtieth of the sets, and leave few pairs whose sets must meet
        near = cut(beside(pairs, "sketch").mapInArrow(lean(sift), "a bigint, b bigint"))
        release(sets.sparkSession)
    return beside(near, "own").mapInArrow(lean(compare), "a bigint, b bigint")


def _entries(sets: DataFrame, order: Order) -> DataFrame:
    """s, node, size, place: the prefixes of sets (node, own), and how many shingles of the text come before in the order."""
    known = sets.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [np.frombuffer(x, np.uint64) for x in b.column("own").to_pylist()]
            if own:
                some = [prefix(x, known.value) for x in own]
                lengths, every = list(map(len, some)), np.concatenate(some)
                yield pa.RecordBatch.from_arrays([pa.array(every.view(np.int64)), pa.array(np.repeat(b.column("node").to_numpy(), lengths)), pa.array(np.repeat(list(map(len, own)), lengths)), pa.array(np.concatenate([np.arange(n) for n in lengths]))], names=["s", "node", "size", "place"])

    return sets.select("node", "own").mapInArrow(lean(run), "s bigint, node bigint, size bigint, place bigint")


def _frequent(sets: DataFrame, order: Order, tables: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """The keys of shingles of more than SMALL of these sets that are not common yet, and their levels, as from _most."""
    known = sets.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                every = np.concatenate([np.frombuffer(x, np.uint64) for x in b.column("own").to_pylist()])
                key, n = np.unique(keys_of(every[known.value.ranks(every) == 0]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], names=["key", "n"])

    often = sets.select("own").mapInArrow(lean(run), "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > SMALL)
    return _most(tables.keep(often))


def differences(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """groups: s, node, size, root. Returns q, node, size, base, own: for each pivot of a node's groups (the root of the group's largest
    component) the sizes of the node's set and the pivot's, and the shingles that one of the two holds alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base, own = [], []
            for x, p in zip(b.column("own").to_pylist(), b.column("pivot").to_pylist(), strict=True):
                base.append(len(p) // 8)
                own.append(np.setxor1d(np.frombuffer(x, np.uint64), np.frombuffer(p, np.uint64), assume_unique=True).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("q"), b.column("node"), b.column("size"), pa.array(base, pa.int64()), pa.array(own, pa.list_(pa.int64()))], names=["q", "node", "size", "base", "own"])

    each = groups.groupBy("s", "root").agg(F.count(F.lit(1)).alias("n"))
    pivot = each.groupBy(F.col("s").alias("ps")).agg(F.max(F.struct("n", "root")).alias("p")).select("ps", F.col("p.root").alias("q"))
    placed = groups.join(pivot.hint("merge"), apart(F.col("s")) == apart(F.col("ps"))).select("q", "node", "size").distinct()
    both = placed.join(sets.select(F.col("node").alias("nx"), "own").hint("merge"), F.col("node") == F.col("nx"))
    both = both.join(sets.select(F.col("node").alias("np"), F.col("own").alias("pivot")).hint("merge"), F.col("q") == F.col("np"))
    return both.select("q", "node", "size", "own", "pivot").mapInArrow(lean(run), "q bigint, node bigint, size bigint, base bigint, own array<bigint>")


def similar_apart(only: Column, sizes: Column) -> Column:
    """Whether sets of this joint size are similar, of which so many shingles are in one set alone."""
    return only * (NUM + DEN) <= sizes * (DEN - NUM)


def pairs_by_differences(differ: DataFrame, roots: DataFrame) -> DataFrame:
    """differ: as from differences(). Pairs (a < b) of nodes of one pivot and different components that can be similar if this is the
    first difference from the pivot that they share, rare ones first. Pairs that need share none are both similar to the pivot."""
    each = differ.select("q", "node", "size", F.size("own").cast("bigint").alias("n"), F.explode("own").alias("t"))
    kinds = each.groupBy(F.col("q").alias("kq"), F.col("t").alias("kt")).agg(F.count(F.lit(1)).alias("holders"))
    held = each.join(kinds.hint("merge"), apart(F.col("q"), F.col("t")) == apart(F.col("kq"), F.col("kt")))
    place = F.row_number().over(Window.partitionBy("q", "node").orderBy("holders", "t")) - 1
    first = held.withColumn("place", place).where((F.col("holders") > 1) & (F.col("place") * NUM <= F.col("size") * (DEN - NUM)))
    at = cut(first.join(roots.select(F.col("node").alias("of"), "root").hint("merge"), F.col("node") == F.col("of"), "left").select("q", "t", "node", "size", "n", "place", F.coalesce("root", "node").alias("root")))
    other = at.select(*[F.col(c).alias(f"{c}2") for c in at.columns])
    most = F.least(F.col("n") - F.col("place"), F.col("n2") - F.col("place2"))
    can = similar_apart(F.col("n") + F.col("n2") - 2 * most, F.col("size") + F.col("size2"))
    both = at.join(other.hint("merge"), (F.col("q") == F.col("q2")) & (F.col("t") == F.col("t2")) & (F.col("node") < F.col("node2")) & (F.col("root") != F.col("root2")) & can)
    return both.select(F.col("node").alias("a"), F.col("node2").alias("b"))


def merged(entries: DataFrame, tables: Scratch) -> DataFrame:
    """entries (s, node, size, place) with one of the groups that have the same members, each member at its first place in
    any of them; known by the number of members and two 64-bit sums of their hashes. Neighbouring shingles of a passage would
    give the same pairs again and again."""
    entries = tables.keep(entries)
    kinds = entries.groupBy("s").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    same = kinds.groupBy("n", "x", "y").agg(F.min("s").alias("one"), F.collect_set("s").alias("every")).select("one", F.explode("every").alias("own"))
    at = entries.join(same.hint("merge"), apart(F.col("s")) == apart(F.col("own")))
    return at.groupBy(F.col("one").alias("s"), "node").agg(F.first("size").alias("size"), F.min("place").alias("place"))


def near_members(rows: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """rows: node, text. Returns node, grp of each row that has a near duplicate; grp is the smallest node reachable.

    seeds: distinct pairs (a < b) that are probably similar; they are verified first, and only once."""
    with Scratch(rows.sparkSession, "near") as tables:
        return cut(_near_members(rows, seeds, tables))


def _near_members(rows: DataFrame, seeds: DataFrame | None, tables: Scratch) -> DataFrame:
    spark = rows.sparkSession
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    order = _common(rows, n + size // 6, tables)
    common, usual = spark.sparkContext.broadcast(order), spark.sparkContext.broadcast(usual_words(rows, tables))
    release(spark)
    buckets, slices = max(LEAST_BUCKETS, (n + size // 30) // BUCKET_ENTRIES), max(8, n // BUCKET_ENTRIES)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 4 << 20):
            parts = []
            for node, text in zip(batch.column("node").to_pylist(), as_bytes(batch.column("text")), strict=True):
                own = shingles(text, usual=usual.value)
                some = prefix(own, common.value)
                part = np.empty(len(some), ENTRY)
                part["s"], part["node"], part["size"] = some, node, len(own)
                parts.append(part)
            entries = np.concatenate(parts)
            lot = np.where(common.value.ranks(entries["s"]) > 0, (entries["node"].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(slices), 0).astype(np.uint64)
            where = ((entries["s"] + lot) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(where, kind="stable")
            entries, where = entries[order], where[order]
            starts = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1])))
            blobs = [entries[a:b].tobytes() for a, b in zip(starts, np.append(starts[1:], len(entries)), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(where[starts]), pa.array(blobs, pa.binary())], names=["bucket", "entries"])

    def group(key: tuple, got: pa.Table) -> pa.Table:
        a, b, more = meet(np.frombuffer(b"".join(got.column("entries").to_pylist()), ENTRY), common.value)
        none = np.zeros(len(a), np.int64)
        return pa.table({"a": np.concatenate([a, more["node"]]), "b": np.concatenate([b, more["s"].view(np.int64)]), "size": np.concatenate([none, more["size"].astype(np.int64)])})

    met = tables.keep(rows.select("node", "text").mapInArrow(lean(deal), "bucket bigint, entries binary").groupBy("bucket").applyInArrow(lean_groups(group), "a bigint, b bigint, size bigint"))
    release(spark)
    first = met.where("size = 0").select("a", "b")
    first = tables.keep((first if seeds is None else first.union(seeds)).distinct())
    part = first.select(F.col("a").alias("w")).union(first.select("b")).union(met.where("size > 0").select("a")).distinct()
    sets = tables.keep(_sets(rows.join(part.hint("merge"), F.col("node") == F.col("w"), "left_semi"), usual))
    release(spark)
    tried = links = None

    def judge(pairs: DataFrame, sifted: bool = False) -> bool:
        """Verifies the pairs (a < b) that were not verified before; whether any is similar."""
        nonlocal tried, links
        new = tables.keep(pairs.distinct() if tried is None else pairs.distinct().join(tried.hint("merge"), ["a", "b"], "left_anti"))
        if new.isEmpty():
            return False
        similar_ = tables.keep(_verified(new, sets, sifted))
        release(spark)
        tried = new if tried is None else tried.union(new)
        links = similar_ if links is None else links.union(similar_)
        return not similar_.isEmpty()

    shrink_heaps(spark)
    judge(first)
    empty = spark.createDataFrame([], "a bigint, b bigint")
    roots = connected_components(links if links is not None else empty)

    def apart_still(entries: DataFrame) -> DataFrame:
        """entries with root, and the number of members of their group: those of groups that hold several components."""
        at = cut(entries.join(roots.select(F.col("node").alias("of"), "root").hint("merge"), F.col("node") == F.col("of"), "left").select("s", "node", "size", "place", F.coalesce("root", "node").alias("root")))
        mixed = at.groupBy(F.col("s").alias("ms")).agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count(F.lit(1)).alias("members")).where("x < y")
        return tables.keep(at.join(mixed.hint("merge"), apart(F.col("s")) == apart(F.col("ms"))).select("s", "node", "size", "place", "root", "members"))

    def stars_of(groups: DataFrame, turn: int) -> DataFrame:
        """One member of each component of a group beside one of its largest component; turn: which members stand for them."""
        each = groups.groupBy("s", "root").agg(F.count(F.lit(1)).alias("n"), F.min_by(F.struct("node", "size"), F.struct(F.xxhash64("node", F.lit(turn)), "node")).alias("m"))
        hub = each.groupBy(F.col("s").alias("hs")).agg(F.max(F.struct("n", "root", "m")).alias("h"))
        both = each.join(hub.hint("merge"), (F.col("s") == F.col("hs")) & (F.col("root") != F.col("h.root"))).where(similar_sizes(F.col("m.size"), F.col("h.m.size")))
        return both.select(F.least("m.node", "h.m.node").alias("a"), F.greatest("m.node", "h.m.node").alias("b"))

    def pairs_of(groups: DataFrame) -> DataFrame:
        """All pairs of members of different components that can be similar if this is the first shingle they share: what comes
        before in either text's order is not shared then."""
        other = groups.select(F.col("s").alias("s2"), F.col("node").alias("node2"), F.col("size").alias("size2"), F.col("place").alias("place2"), F.col("root").alias("root2"))
        most = F.least(F.col("size") - F.col("place"), F.col("size2") - F.col("place2"))
        both = groups.join(other.hint("merge"), (F.col("s") == F.col("s2")) & (F.col("node") < F.col("node2")) & (F.col("root") != F.col("root2")) & similar(most, F.col("size"), F.col("size2")))
        return both.select(F.col("node").alias("a"), F.col("node2").alias("b"))

    entries = met.where("size > 0").select(F.col("b").alias("s"), F.col("a").alias("node"), "size", F.lit(0).cast("bigint").alias("place"))
    found = lambda: roots.select("node", F.col("root").alias("grp")).union(roots.select("root", "root").distinct())
    placed = False
    while True:
        shrink_heaps(spark)
        left = apart_still(merged(entries, tables))
        for turn in range(TURNS):
            if not judge(stars_of(left, turn), sifted=True):
                break
            roots = connected_components(links)
            left = apart_still(left.select("s", "node", "size", "place"))
        if judge(pairs_of(left.where(F.col("members") <= SMALL)), sifted=True):
            roots = connected_components(links)
        release(spark)
        large = left.where(F.col("members") > SMALL)
        if large.isEmpty():
            return found()
        again = large.select(F.col("node").alias("n")).distinct()
        held = tables.keep(sets.join(again.hint("merge"), F.col("node") == F.col("n"), "left_semi").select("node", "own"))
        fresh = _frequent(held, order, tables)
        if not len(fresh[0]) and placed:  # the texts of large groups have none but common shingles
            differ = tables.keep(differences(large, sets))
            close = differ.where((F.col("q") != F.col("node")) & similar_apart(F.size("own"), F.col("size") + F.col("base")))
            if judge(close.select(F.least("q", "node").alias("a"), F.greatest("q", "node").alias("b"))):
                roots = connected_components(links)
            if judge(pairs_by_differences(differ, roots), sifted=True):
                roots = connected_components(links)
            return found()
        order, placed = order.after(*fresh), True
        entries = tables.keep(_entries(held, order))
