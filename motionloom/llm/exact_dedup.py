"""Exact duplicates by 128-bit content hash, with the bytes compared inside each hash group. DataFrame functions only.

Plan: one hash aggregation by (hash, text) compares bytes and pre-aggregates on the map side, so a group that holds a
third of all rows leaves each task as one row. Each row finds its group again by (hash, SHA-256); that join carries no
text, and adaptive execution splits a hot key. Should two different texts ever share both hashes, the query stops.

Defined results: null text is the empty text. Only A-Z are lower-cased. A null id never wins against another id; if all
ids of a group are null, keep_id is null and all its rows stay. Rows with equal id and text are the same document and
get the same flags. An empty table gives an empty result. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motionloom.llm.common import UPPER, apart, ascii_lower, table


def content_hash(text: Column) -> Column:
    """128 bits."""
    return F.unhex(F.md5(text))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", hash_fn: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per input row: id_col, keep_id, group_size, kept, text_sha256.

    keep: "min" or "max", which id of a group stays. hash_fn: content hash, to be replaced in tests of collisions."""
    best = {"min": F.min, "max": F.max}[keep]
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), ascii_lower(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("norm"))
    rows = rows.withColumns({"h": hash_fn(F.col("norm"))})
    by_text = rows.groupBy("h", "norm").agg(F.count(F.lit(1)).alias("n"), best("id").alias("keep"))
    groups = (
        by_text.select("h", F.sha2("norm", 256).alias("sha"), "n", "keep")
        .groupBy("h", "sha").agg(F.count(F.lit(1)).alias("texts"), F.max("n").alias("n"), F.max("keep").alias("keep"))
        .withColumn("n", F.when(F.col("texts") == 1, F.col("n")).otherwise(F.raise_error(F.lit("two texts share both content hashes")).cast("bigint")))
        .select(F.col("h").alias("gh"), F.col("sha").alias("gsha"), "n", "keep")
    )
    back = rows.select("id", "h", F.sha2("norm", 256).alias("sha"))
    return back.join(groups, apart(F.col("h"), F.col("sha")) == apart(F.col("gh"), F.col("gsha"))).select(
        F.col("id").alias(id_col), F.col("keep").alias("keep_id"), F.col("n").alias("group_size"), F.col("id").eqNullSafe(F.col("keep")).alias("kept"), F.col("sha").alias("text_sha256")
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """The rows of docs, all columns, that stay: per group of equal texts exactly one, that with the smallest (or largest) id.

    Rows that share this id, or a group without ids: the smallest row by text and the other columns stays, which therefore
    must have an order (no maps). Rows of equal id and text meet in an aggregate with a map side, so a row repeated many
    times leaves each task once; the anti-join then keeps that partitioning and moves only the keys of dropped rows."""
    key = lambda i, sha: F.concat(sha, F.when(i.isNull(), "-").otherwise(F.concat(F.lit("="), i.cast("string"))))
    sha = F.sha2(ascii_lower(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))), 256)
    names = [text_col] + [c for c in docs.columns if c != text_col]
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)])
    one = docs.select(key(F.col(f"`{id_col}`"), sha).alias("__k"), row.alias("__row")).groupBy("__k").agg(F.min("__row").alias("__row"))
    gone = exact_groups(docs, id_col, text_col, keep).where(~F.col("kept")).select(key(F.col(id_col), F.col("text_sha256")).alias("__gone"))
    left = one.join(gone, F.col("__k") == F.col("__gone"), "left_anti")
    return left.select(*[F.col(f"__row.c{names.index(c)}").alias(c) for c in docs.columns])


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"), keep="max")


SQL = f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g USING (norm)
"""
