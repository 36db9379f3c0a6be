"""Ranked lexical search, score at a time over impact-ordered postings.

The documents stay where they are: each task reads its documents in slices of bounded size and indexes a slice by itself.
A term's postings are grouped by exact impact, the highest first. For an item, the groups of all its terms are taken in
descending order of weight times impact and added into one sum per document. The item is done with a slice as soon as the
bounds prove it: what the heads of the lists can still add, all together, neither lifts a document that is not among a few
candidates to the k-th best score so far, nor one that was not met at all. Only then are the candidates' scores completed
from the slice's forward index. The k-th best score is carried from slice to slice of a task, so that most slices are soon
done. A task returns k documents per item at most; these meet in two rounds, first by (item, share of the documents).

Items come in blocks of a bounded number of terms, since a block's terms are broadcast. Per block there is a pass for the
document frequencies of its terms, then the search. Nothing is stored, and a lost task reads its documents again.

Defined results: null and empty texts have no terms; they don't count in the number of documents and are never found. Items
without terms have no rows. Documents that repeat an id, or have none, are documents of their own; of equal scores, those without
id come last. Rows that repeat an item_id are items of their own. Empty tables give an empty result. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from motionloom.llm.common import UPPER, cut, small_batches, table, text_slices
from motionloom.llm.words import words_of
from motionloom.operators.ranks import in_order

K = 10
BLOCK_TERMS = 200_000
SLICE_BYTES = 8 << 20
#: An item is not done with a slice while more candidates than this remain, unless its postings end before.
CANDIDATES = 64
SHARES = 64
ONE = 1_000_000_000


def term_weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, length: np.ndarray, n: int, total: int) -> np.ndarray:
    """tf and length: of each posting's document. Whole numbers throughout, in Python's own where 64 bits might not do."""
    if len(length) and int(length.max()) * 90 * n < 1 << 63:
        m = 10 + 90 * length * n // total
    else:
        m = np.array([10 + 90 * x * n // total for x in length.tolist()], np.int64)
    return ONE * tf // (1000 * tf + 8 * m)


class Slice:
    """The index of one slice: postings by (term, impact descending), and by document."""

    def __init__(self, texts: pa.Array, vocabulary: pa.Array, n: int, total: int):
        words, lengths = words_of(texts)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        term = pc.index_in(words, value_set=vocabulary)
        known = term.is_valid().to_numpy(zero_copy_only=False)
        keys, tf = np.unique(owner[known] * len(vocabulary) + term.drop_null().to_numpy(), return_counts=True)
        self.doc, self.term = keys // max(1, len(vocabulary)), keys % max(1, len(vocabulary))
        self.impact = impacts(tf, lengths[self.doc], n, total)
        self.doc_at = np.searchsorted(self.doc, np.arange(len(lengths) + 1))
        order = np.lexsort((-self.impact, self.term))
        self.by_impact_doc, self.falling = self.doc[order], -self.impact[order]
        self.term_at = np.searchsorted(self.term[order], np.arange(len(vocabulary) + 1))
        self.docs = len(lengths)

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, bar: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) with all of the slice's k best that reach bar, the k-th best score elsewhere."""
        lists = [[int(w), self.falling[a:b], self.by_impact_doc[a:b], 0] for w, a, b in zip(weights, self.term_at[terms], self.term_at[terms + 1], strict=True) if w > 0 and b > a]
        heads = np.array([-w * int(i[0]) for w, i, _, _ in lists], np.int64)
        rest, level = int(heads.sum()), int(heads.max(initial=0))
        if not rest or rest < bar:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        sums = np.zeros(self.docs, np.int64)
        while True:
            for at, one in enumerate(lists):
                if heads[at] < level:
                    continue
                w, falling, doc, done = one
                to = done + int(np.searchsorted(falling[done:], -level // w, side="right"))  # the groups of w * impact >= level
                sums[doc[done:to]] -= w * falling[done:to]
                one[3] = to
                heads[at] = -w * int(falling[to]) if to < len(falling) else 0
            rest = int(heads.sum())
            if self.docs > k:
                bar = max(bar, int(np.partition(sums, self.docs - k)[self.docs - k]))
            # a document outside the candidates can't reach bar, whether it was met or not
            left = np.flatnonzero(sums + rest >= max(bar, 1))
            if not rest:
                return left, sums[left]
            if len(left) <= CANDIDATES:
                return self._completed(left, terms, weights)
            level = min(int(heads.max()), level * 3 // 4 + 1)

    def _completed(self, docs: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        by_term = np.argsort(terms)
        own, own_w = terms[by_term], weights[by_term]
        scores = np.zeros(len(docs), np.int64)
        for i, d in enumerate(docs):
            a, b = self.doc_at[d], self.doc_at[d + 1]
            at = np.minimum(np.searchsorted(own, self.term[a:b]), len(own) - 1)
            hit = own[at] == self.term[a:b]
            scores[i] = (own_w[at[hit]] * self.impact[a:b][hit]).sum()
        return docs, scores


def _frequencies(docs: DataFrame, vocabulary) -> tuple[int, int, dict[int, int]]:
    """Documents with terms, terms of all documents, and by place in the vocabulary the documents that have the term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, n, total = vocabulary.value, 0, 0
        df = np.zeros(len(terms), np.int64)
        for b in text_slices(batches, SLICE_BYTES):
            words, lengths = words_of(b.column("text"))
            n, total = n + int((lengths > 0).sum()), total + int(lengths.sum())
            term = pc.index_in(words, value_set=terms)
            known = term.is_valid().to_numpy(zero_copy_only=False)
            keys = np.unique(np.repeat(np.arange(len(lengths)), lengths)[known] * len(terms) + term.drop_null().to_numpy())
            df += np.bincount(keys % max(1, len(terms)), minlength=len(terms))
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1, -2], some]), pa.int64()), pa.array(np.concatenate([[n, total], df[some]]), pa.int64())], names=["term", "n"])

    got = docs.mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # a block's terms at most
    found = dict(zip(got.column("term").to_pylist(), got.column("n").to_pylist(), strict=True))
    return found.pop(-1, 0), found.pop(-2, 0), found


def _items(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """number, item, terms (distinct), block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, SLICE_BYTES):
            words, lengths = words_of(b.column("text"))
            ends = np.concatenate([[0], np.cumsum(lengths)])
            terms = [words[a:z].unique().to_pylist() for a, z in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("item"), pa.array(terms, pa.list_(pa.binary()))], names=["item", "terms"])

    kind = items.schema[id_col].dataType.simpleString()
    rows = items.select(F.col(f"`{id_col}`").alias("item"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, f"item {kind}, terms array<binary>")
    placed = in_order(rows.where(F.size("terms") > 0).withColumn("n", F.size("terms").cast("bigint")), F.col("item"), totals={"before": "n"})
    return placed.withColumn("block", F.floor(F.col("before") / BLOCK_TERMS)).drop("n", "before")


def _best(found: DataFrame, k: int) -> DataFrame:
    """number, id, score, rank: the k best of each number."""
    top = lambda df, *by: df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.col("id").asc_nulls_last()))).where(F.col("rank") <= k)
    shared = top(found.withColumn("share", F.pmod(F.xxhash64("id"), F.lit(SHARES))), "number", "share").drop("rank", "share")
    return top(shared, "number")


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_col, rank (from 1), id_col, score: for each item the k documents with the highest scores above 0, ties to the smaller id."""
    spark = docs.sparkSession
    src = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    asked = _items(items, item_col, item_text_col)
    last = asked.agg(F.max("block")).first()[0]
    found = spark.createDataFrame([], "number bigint, id bigint, score bigint")
    for block in range(-1 if last is None else last, -1, -1):
        rows = asked.where(F.col("block") == block).select("number", "terms").toArrow()  # BLOCK_TERMS terms, and those of one item
        if not rows.num_rows:
            continue
        flat = rows.column("terms").combine_chunks().flatten().cast(pa.large_binary())
        vocabulary = flat.unique()
        where = pc.index_in(flat, value_set=vocabulary).to_numpy()
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(rows.column("terms")).to_numpy())])
        with small_batches(spark):
            n, total, df = _frequencies(src.select("text"), words := spark.sparkContext.broadcast(vocabulary))
        weights = np.array([term_weight(n, df.get(t, 0)) for t in range(len(vocabulary))], np.int64)
        todo = [(number, where[a:z], weights[where[a:z]]) for number, a, z in zip(rows.column("number").to_pylist(), ends[:-1], ends[1:], strict=True)]
        with small_batches(spark):
            found = found.union(cut(_searched(src, words, spark.sparkContext.broadcast(todo), n, total, k)))
    names = asked.select(F.col("number").alias("no"), "item")
    return _best(found, k).join(names, F.col("number") == F.col("no")).select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def _searched(src: DataFrame, vocabulary, todo, n: int, total: int, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {number: [] for number, _, _ in todo.value}  # (-score, no id, id) of k documents at most, ascending
        for b in text_slices(batches, SLICE_BYTES):
            index, ids = Slice(b.column("text"), vocabulary.value, n, total), b.column("id").to_pylist()
            for number, terms, weights in todo.value:
                held = best[number]
                docs, scores = index.search(terms, weights, k, -held[-1][0] if len(held) == k else 0)
                if len(docs):
                    best[number] = sorted(held + [(-s, ids[d] is None, ids[d] or 0) for d, s in zip(docs.tolist(), scores.tolist(), strict=True) if s > 0])[:k]
        rows = [(number, None if none else i, -s) for number, held in best.items() for s, none, i in held]
        cols = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["number", "id", "score"])

    return src.mapInArrow(run, "number bigint, id bigint, score bigint")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL = f"""
WITH t AS (SELECT doc_id, row_number() OVER () AS r, {_TERMS} AS ts FROM documents),
g AS (SELECT count(*) AS n, CAST(sum(len(ts)) AS BIGINT) AS l FROM t WHERE len(ts) > 0),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM t) GROUP BY ALL),
f AS (SELECT term, CAST(floor(1000 * ln((2 * g.n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, g GROUP BY term, g.n),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
m AS (SELECT r, doc_id, 10 + (90 * len(ts) * g.n) // g.l AS m FROM t, g WHERE len(ts) > 0),
s AS (SELECT item_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score, any_value(doc_id) AS doc_id FROM q JOIN f USING (term) JOIN p USING (term) JOIN m USING (r) GROUP BY item_id, r),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 10
"""
