"""Exact percentiles of tables of any size, in groups of any size: no task holds the distinct values of a group.

Values are counted (with a map side), the counts are put in order over ranges of (group, value), and a percentile is read off
the rows whose ranks it lies between. Nothing but one row per range meets in one place, and no group is one task's.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motionloom.functions.vectors import finite
from motionloom.operators.ranks import in_order
from motionloom.shared import cut


def percentiles(table: DataFrame, by: Sequence[str], values: Mapping[str, Column], shares: Sequence[float]) -> DataFrame:
    """by, metric (the key in values), n, ends (an array with the percentile of each share, 0 to 1, in the order given).

    Linear between the two nearest ranks. Only finite values count; a group without any has no row. Null is a group like any
    other. Columns of by may have any names but metric, n and ends."""
    keys = [f"k{i}" for i in range(len(by))]
    pairs = F.explode(F.array(*[F.struct(F.lit(name).alias("metric"), finite(x.cast("double")).alias("x")) for name, x in values.items()]))
    long = table.select(*[F.col(f"`{b}`").alias(k) for b, k in zip(by, keys, strict=True)], pairs.alias("pair")).select(*keys, "pair.*").where("x IS NOT NULL")
    group = [*keys, "metric"]
    counts = long.groupBy(*group, "x").agg(F.count(F.lit(1)).alias("c"))
    placed = in_order(counts, *[F.col(c) for c in (*group, "x")], totals={"before": "c"})
    own = placed.groupBy(*[F.col(k).alias(f"g{i}") for i, k in enumerate(group)]).agg(F.min("before").alias("start"), F.sum("c").alias("n"))
    same = F.lit(True)
    for i, k in enumerate(group):
        same = same & F.col(k).eqNullSafe(F.col(f"g{i}"))
    first = F.col("before") - F.col("start")
    place = [(F.col("n") - 1) * F.lit(float(p)) for p in shares]
    holds = lambda rank: (first <= rank) & (rank < first + F.col("c"))
    joined = placed.join(own, same)
    ends = [F.struct(F.max(F.when(holds(F.floor(at)), F.col("x"))).alias("low"), F.max(F.when(holds(F.ceil(at)), F.col("x"))).alias("high"), F.first(at).alias("at")) for at in place]
    got = joined.groupBy(*group).agg(F.first("n").alias("n"), F.array(*ends).alias("ends"))
    between = lambda e: F.when(e["low"] == e["high"], e["low"]).otherwise((F.ceil(e["at"]) - e["at"]) * e["low"] + (e["at"] - F.floor(e["at"])) * e["high"])
    return got.select(*[F.col(k).alias(b) for b, k in zip(by, keys, strict=True)], "metric", "n", F.transform("ends", between).alias("ends"))


def whole(table: DataFrame, values: Mapping[str, Column], shares: Sequence[float]) -> dict[str, tuple[int, list[float]]]:
    """(number of finite values, percentiles) over the whole table, by metric; (0, []) where there is no value."""
    found = {r["metric"]: (r["n"], list(r["ends"])) for r in percentiles(table, [], values, shares).collect()}
    return {name: found.get(name, (0, [])) for name in values}


def summaries(table: DataFrame, by: Sequence[str], x: Column, prefix: str, wanted: Sequence[str]) -> DataFrame:
    """What stats.summary gives, for few groups of any size: by, and {prefix}_{w} for w of n, mean, std, min, max, rms and
    p<number>. Groups without a finite value keep their row, with n 0 and nulls."""
    shares = sorted({int(w[1:]) for w in wanted if w[1:].isdigit()})
    v = finite(F.col("x"))
    keys = [f"k{i}" for i in range(len(by))]
    table = cut(table.select(*[F.col(f"`{b}`").alias(k) for b, k in zip(by, keys, strict=True)], x.cast("double").alias("x")))
    made = {"n": F.count(v), "mean": F.avg(v), "std": F.stddev_pop(v), "min": F.min(v), "max": F.max(v), "rms": F.sqrt(F.avg(v * v))}
    out = table.groupBy(*keys).agg(*[made[w].alias(w) for w in wanted if w in made])
    if shares:
        ends = percentiles(table, keys, {"x": F.col("x")}, [p / 100 for p in shares]).select(*[F.col(k).alias(f"g{i}") for i, k in enumerate(keys)], "ends")
        same = F.lit(True)
        for i, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"g{i}"))
        out = out.join(ends, same, "left").withColumns({f"p{p}": F.get("ends", F.lit(i)) for i, p in enumerate(shares)})
    return out.select(*[F.col(k).alias(b) for b, k in zip(by, keys, strict=True)], *[F.col(w).alias(f"{prefix}_{w}") for w in wanted])
