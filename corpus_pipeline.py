"""From raw documents to packed training sequences: quality, exact copies, near copies, repeated passages, packing.

Each stage reads what the one before it has written. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from motionloom.llm import exact_dedup, packing, quality, simhash, suffix_dedup
from motionloom.llm.bpe import WORD_BPE, vocabulary_path
from motionloom.llm.common import fresh_dir, shrink_heaps, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores under 0.3 go. It learns from the labelled rows among docs.

    Null and empty texts are scored like any other; rows without id are scored but not learned from; repeated rows share a
    score, so they stay or go together. An empty table, or labels of one class, give every text the same share as score."""
    shrink_heaps(spark)
    return quality.keep_quality(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) exactly one row stays: that with the smallest id, and one without id only if no row of
    the group has one; of rows with equal ids the smallest by text and the other columns. Null text equals empty text."""
    shrink_heaps(spark)
    return exact_dedup.drop_exact_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that pairs of a Jaccard similarity of 0.8 or more (five-word shingles) connect, exactly one row stays: that
    with the smallest id. Texts without words are one group; rows without id and repeated rows as in the exact stage."""
    shrink_heaps(spark)
    return simhash.drop_near_duplicates(docs)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every byte that a repeated 200-byte window covers is cut from the text, in every document that has it; all rows stay,
    and null texts stay null. No text has an equal left by now, so that only passages go, never a whole group of copies."""
    shrink_heaps(spark)
    return suffix_dedup.remove_repeats(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens, with their ids. Null and empty texts are the end id alone; rows without id are packed
    like any other; an empty table gives no sequence."""
    shrink_heaps(spark)
    return packing.pack(docs, vocabulary_path(WORD_BPE))


STAGES = [("quality classifier", quality_stage), ("exact dedup", exact_stage), ("SimHash near-dedup", near_stage), ("suffix-array dedup", repeats_stage), ("packing", packing_stage)]

#: Trained models, fingerprints over components and tokenizers have no SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_dir(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
