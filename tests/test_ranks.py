"""Row numbers and running totals over ranges."""

import random

from pyspark.sql import functions as F

from motionloom.operators.ranks import free_name, in_order


def test_numbers_and_totals(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["", "a", "é", "z", None]) if i % 3 else f"s{i}", i, rng.choice([None, 1, 5, 100]), i * 2) for i in range(400)]
    df = spark.createDataFrame(rows, "s string, id bigint, size bigint, `at` bigint")
    got = {r.id: r for r in in_order(df, F.col("s").asc_nulls_last(), F.col("id"), totals={"before": "size"}, ranges=7).collect()}
    total = 0
    for k, (s, i, size, at) in enumerate(sorted(rows, key=lambda r: (r[0] is None, (r[0] or "").encode(), r[1]))):
        assert (got[i].number, got[i].before, got[i]["at"], got[i].s) == (k, total, at, s)
        total += size or 0


def test_empty_and_equal_keys(spark):
    df = spark.range(100).select(F.lit(1).alias("k"), F.lit(2).alias("n"))
    got = in_order(df, F.col("k"), totals={"t": "n"}).collect()
    assert sorted((r.number, r.t) for r in got) == [(i, 2 * i) for i in range(100)]
    assert in_order(df.where("k = 2"), F.col("k"), totals={"t": "n"}).count() == 0


def test_free_name():
    assert free_name(["a", "_At"], "at") == "at" and free_name(["AT", "_at"], "at") == "__at"
