"""The registered queries against their SQL, and the pipeline's stages."""

import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from motionloom.llm import queries as Q


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got = Q.queries()[name](spark, sf).toPandas()
    expected = con.sql(Q.oracle_sql()[name]).df()
    cols = sorted(expected.columns)
    assert sorted(got.columns) == cols
    plain = lambda x: None if pd.isna(x) else int(x) if isinstance(x, float) and x.is_integer() else x
    clean = lambda df: sorted(str([plain(x) for x in r]) for r in df[cols].astype(object).values.tolist())
    assert clean(got) == clean(expected)


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in Q.queries()) == list(range(1, 14))


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.columns == columns, name
        assert docs.count() <= kept
        kept = docs.count()
    assert docs.groupBy(F.lower("text")).count().where("count > 1 AND length(lower(text)) >= 200").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert packed.select("doc_id").distinct().count() == kept


def test_repeated_rows_and_null_ids_keep_one_copy(spark, sf):
    """Through all stages: a long document repeated row by row, and one whose copies have no id, each stay once and whole."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rng = random.Random(8)
    made = [" ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(120)) for _ in range(2)]
    extra = [(900_001, made[0])] * 3 + [(None, made[1])] * 3
    more = spark.createDataFrame(extra, "doc_id bigint, text string")
    docs = docs.unionByName(more, allowMissingColumns=True).withColumn("n_chars", F.coalesce("n_chars", F.length("text")).cast(docs.schema["n_chars"].dataType))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        if k:  # what the classifier thinks of invented words doesn't matter here
            docs = stage(spark, docs, sf)
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        else:
            stage(spark, docs, sf).count()
        if 1 <= k <= 3:
            assert sorted(r.text for r in docs.where(F.col("doc_id") == 900_001).collect()) == made[:1], name
            assert [r.text for r in docs.where(F.col("text") == made[1]).collect()] == made[1:], name
    assert docs.where(F.col("doc_id") == 900_001).count() >= 1 and docs.where("doc_id IS NULL").count() >= 1


def test_empty_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.count() == 0
