"""Mixing sources to target weights by capped water-filling. DataFrame functions only.

Targets: a source of weight w gets level * w words, but at most `most` times what it has; the excess goes to the others by weight
until none is above. In ascending order of cap / w the clamped sources come first, and with the first k of them clamped the
level is (total - their caps) / (weights of the rest). That rises while clamping is due and falls afterwards, so the level
is its maximum over k: one running total over the sources instead of rounds.

Sampling: a source with target t and s words is repeated floor(t / s) times in whole. The rest is a fraction of one more
repetition: its documents stand in the order of a seeded hash, and those before the word where the rest ends are taken
once more. The document on that border is taken up to that word, so that a source meets its target to within a word, by
however long a document.

Skew: a source's order is never sorted as one group. The hash is cut into slices, slices are summed before the shuffle,
and only the slice on the border is sorted: two groups of about the square root of the number of documents. Source totals go back to the documents by a broadcast of at most MOST_BROADCAST
rows, else by a join that adaptive execution can split.

Defined results: null text has size 0, null source is a source of its own and the last one. Sources without words have target 0.
Documents of equal id and size in one source share the border, rounded down to a word each; so rows without id are
taken whole, evenly in part, or not, by their size. Repeated rows are documents of their own. An empty table gives an
empty result. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from motionloom.llm.common import cut, table
from motionloom.operators.ranks import in_order

MOST_BROADCAST = 10_000


def word_count(text: Column) -> Column:
    """Number of maximal runs without white space: each run, with the space after it, becomes one letter."""
    letters = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", "x")
    return F.length(F.btrim(letters, F.lit(" \t\n\x0b\x0c\r")))


def water_levels(sources: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """sources: source, source_size -> these with weight and target, one row per source. Weights repeat over the sources in order."""
    numbered = in_order(sources, F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int")).cast("bigint")
    placed = numbered.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most).drop("number")
    steps = in_order(placed, F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last(), totals={"caps": "cap", "weights": "weight"})
    total, whole = steps.agg(F.sum("source_size"), F.sum("weight")).first()
    level = steps.agg(F.max((F.lit(total) - F.col("caps")).cast("double") / (F.lit(whole) - F.col("weights")))).first()[0]
    return steps.select("source", "source_size", "weight", F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight")).cast("double").alias("target"))


def bounded(small: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(small) if rows <= MOST_BROADCAST else small


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """id_col, source_col, size, source_size, target, taken (words of the mix that come from the document), repeats (how often
    it is taken whole), part (words of a last repetition that is cut): one row per input row.

    The total of all sizes is shared out; weights go to the sources in order of their names."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").cast("string").alias("source"), word_count(F.col(f"`{text_col}`")).cast("bigint").alias("size"))
    rows = cut(rows.withColumn("key", key))  # without the texts, which no later step reads
    n = rows.count()
    bits = min(32, math.ceil(math.log2(max(1, n)) / 2))  # so that slices, and the documents of one, are about the root of n
    lot = F.shiftright(F.conv(F.substring("key", 1, 8), 16, 10).cast("bigint"), 32 - bits)
    rows = rows.withColumn("lot", lot)

    lots = cut(rows.groupBy("source", "lot").agg(F.sum("size").alias("words")))
    sources = cut(water_levels(lots.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most))
    k = sources.count()
    size = F.col("source_size")
    sources = sources.withColumn("whole", F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("bigint"))
    sources = sources.withColumn("rest", F.greatest(F.lit(0), F.floor(F.col("target") - F.col("whole") * size)).cast("bigint"))

    # the slice, then the document, in which the rest ends
    of = lambda names: bounded(sources.select(F.col("source").alias("s"), *names), k)
    before = lambda order, x: F.coalesce(F.sum(x).over(Window.partitionBy("source").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cuts = lots.withColumn("before", before(["lot"], "words")).join(of(["rest"]), F.col("source").eqNullSafe(F.col("s")))
    cuts = cuts.where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words"))).select(F.col("s"), F.col("lot").alias("cut_lot"), (F.col("rest") - F.col("before")).alias("left"))
    inside = rows.join(bounded(cuts, k), F.col("source").eqNullSafe(F.col("s")) & (F.col("lot") == F.col("cut_lot")))
    entries = inside.groupBy("source", "key", "size").agg(F.count(F.lit(1)).alias("copies"), F.first("left").alias("left"))
    entries = entries.withColumn("before", before(["key", "size"], F.col("size") * F.col("copies")))
    border = entries.where((F.col("before") <= F.col("left")) & (F.col("left") < F.col("before") + F.col("size") * F.col("copies"))).select(F.col("source").alias("b"), F.struct("key", "size").alias("border"), F.floor((F.col("left") - F.col("before")) / F.col("copies")).cast("bigint").alias("share"))
    plans = cut(sources.join(border, F.col("source").eqNullSafe(F.col("b")), "left").select(F.col("source").alias("s"), "source_size", "target", "whole", "border", "share"))

    back = rows.join(bounded(plans, k), F.col("source").eqNullSafe(F.col("s")))
    here = F.struct("key", "size")
    once = F.when(F.col("border").isNull(), 0).when(here < F.col("border"), F.col("size")).when(here == F.col("border"), F.col("share")).otherwise(0)
    back = back.withColumn("once", once.cast("bigint"))
    full = (F.col("once") == F.col("size")) & (F.col("size") > 0)
    return back.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("once")).alias("taken"),
        (F.col("whole") + F.when(full, 1).otherwise(0)).alias("repeats"), F.when(full, 0).otherwise(F.col("once")).cast("bigint").alias("part"),
    )


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size, md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][r % 3 + 1] AS weight, 3 * source_size AS cap FROM s),
o AS (SELECT *, coalesce(sum(cap) OVER o, 0) AS caps, coalesce(sum(weight) OVER o, 0) AS weights FROM w
 WINDOW o AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT max(CAST((SELECT sum(source_size) FROM w) - caps AS DOUBLE) / CAST((SELECT sum(weight) FROM w) - weights AS DOUBLE)) AS level FROM o),
t AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), level * weight) AS target FROM o, l),
u AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
v AS (SELECT *, greatest(0, CAST(floor(target - whole * source_size) AS BIGINT)) AS rest FROM u),
c AS (SELECT d.*, v.source_size, v.target, v.whole, v.rest, coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, d.size, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d JOIN v ON d.source IS NOT DISTINCT FROM v.source)
SELECT doc_id, size, source_size, target, CAST(whole * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken FROM c
"""
