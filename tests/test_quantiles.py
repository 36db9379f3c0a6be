"""Percentiles over ordered ranges against NumPy, over groups with ties, gaps and values that are not finite."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from motionloom.operators import quantiles, stats

SHARES = [0.0, 0.05, 0.5, 0.95, 0.99, 1.0]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    out = [("big", float(x)) for x in rng.normal(size=3000)] + [("ties", float(x)) for x in rng.integers(0, 4, 500)]
    out += [("one", 7.0), (None, 1.0), (None, 2.0), ("none", None), ("none", math.nan), ("mixed", 1.0), ("mixed", math.inf), ("mixed", 3.0), ("mixed", None)]
    return out + [("wide", x) for x in (-1.7e308, 5e-324, 0.0, 1.7e308, 1e-300)]


def test_groups_equal_numpy(spark, rows):
    table = spark.createDataFrame(rows, "metric string, v double").repartition(7)
    got = {r["metric"]: r for r in quantiles.summaries(table, ["metric"], F.col("v"), "v", ("n", "mean", "min", "max", *[f"p{int(p * 100)}" for p in SHARES])).collect()}
    assert set(got) == {g for g, _ in rows}
    for name, r in got.items():
        x = [v for g, v in rows if g == name and v is not None and math.isfinite(v)]
        assert r["v_n"] == len(x)
        if not x:
            assert r["v_p50"] is None and r["v_mean"] is None
            continue
        for p in SHARES:
            assert r[f"v_p{int(p * 100)}"] == pytest.approx(np.percentile(x, p * 100), rel=1e-12), (name, p)


def test_whole_table_and_empty(spark, rows):
    table = spark.createDataFrame([(i, v, float(i)) for i, (_, v) in enumerate(rows[:3500])], "i int, v double, w double")
    got = quantiles.whole(table, {"v": F.col("v"), "w": F.col("w"), "no": F.lit(None).cast("double")}, [0.5, 0.25])
    assert got["no"] == (0, []) and got["w"] == (3500, [1749.5, 874.75])
    assert got["v"][1] == pytest.approx(np.percentile([v for _, v in rows[:3500]], [50, 25]))
    empty = table.where("i < 0")
    assert quantiles.whole(empty, {"v": F.col("v")}, [0.5]) == {"v": (0, [])}
    assert stats.robust_mask(empty, "v").count() == 0 and stats.robust_scores(empty, ["v"]).count() == 0


def test_scores_without_values(spark):
    table = spark.createDataFrame([(i, None, 2.0, math.nan) for i in range(9)], "i int, a double, b double, c double")
    assert {(r["outlier_score"], r["top_metric"]) for r in stats.robust_scores(table, ["a", "b", "c"]).collect()} == {(0.0, "")}
    assert stats.robust_masks(table, [("a", True, "x"), ("b", True, "y")]).where("x OR y").count() == 0


def test_no_group_is_one_task(spark):
    """All rows of one group: the plan has no percentile state and the ranges share the rows."""
    table = spark.range(20000).select(F.col("id").cast("double").alias("v"))
    got = quantiles.percentiles(table, [], {"v": F.col("v")}, [0.5])
    plan = got._jdf.queryExecution().toString()
    assert "percentile" not in plan.lower()
    assert got.first()["ends"] == [9999.5]
