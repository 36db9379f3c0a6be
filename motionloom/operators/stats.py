"""Aggregates: finite summaries, robust outliers, guarded correlation, errors, weighted means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motionloom.functions.vectors import finite
from motionloom.operators.quantiles import summaries, whole
from motionloom.shared import cut

MAD_SCALE, MAD_LIMIT, MAD_LEAST, MAD_EPS = 0.6745, 3.5, 8, 1e-12


def summary(x: Column, prefix: str, wanted: Sequence[str] = ("mean", "std", "p95", "p99", "max")) -> list[Column]:
    """Aggregates of the finite values of x: population deviation, linear percentiles; null where there are none.

    For groups as small as an episode; quantiles.summaries serves groups of any size."""
    v = finite(x)
    shares = sorted({int(w[1:]) for w in wanted if w[1:].isdigit()})
    ends = F.percentile(v, F.array(*[F.lit(p / 100) for p in shares]))  # one state for all of them
    made = {"n": F.count(v), "mean": F.avg(v), "std": F.stddev_pop(v), "min": F.min(v), "max": F.max(v), "rms": F.sqrt(F.avg(v * v)), **{f"p{p}": ends[i] for i, p in enumerate(shares)}}
    return [made[w].alias(f"{prefix}_{w}") for w in wanted]


def _spread(table: DataFrame, metrics: Sequence[str], shares: Sequence[float]) -> dict[str, tuple[int, list[float], float | None]]:
    """Per metric: finite values, percentiles of the shares, and the median distance from the median, the first share."""
    x = {m: F.col(f"`{m}`").cast("double") for m in metrics}
    ends = whole(table, x, shares)
    far = whole(table, {m: F.abs(x[m] - ends[m][1][0]) for m in metrics if ends[m][0]}, [0.5]) if any(n for n, _ in ends.values()) else {}
    return {m: (*ends[m], far[m][1][0] if ends[m][0] else None) for m in metrics}


def robust_masks(table: DataFrame, wanted: Sequence[tuple[str, bool, str]]) -> DataFrame:
    """Adds a flag for each (metric, high, name): 0.6745 (x - median) / MAD beyond 3.5, above if high, else below.

    Fewer than 8 finite values flag nothing; with no spread, what is beyond the 95th (5th) percentile is flagged, if that is
    not the median. The percentiles are exact and read off ordered ranges; three numbers per metric reach the driver."""
    if not wanted:
        return table
    table = cut(table)
    found = _spread(table, list(dict.fromkeys(m for m, _, _ in wanted)), [0.5, 0.05, 0.95])
    flags = []
    for m, high, name in wanted:
        n, ends, mad = found[m]
        if n < MAD_LEAST:
            flags.append(F.lit(False).alias(name))
            continue
        sign, median, edge, x = 1 if high else -1, ends[0], ends[2 if high else 1], finite(F.col(f"`{m}`").cast("double"))
        flag = sign * MAD_SCALE * (x - median) / mad > MAD_LIMIT if mad > MAD_EPS else (sign * (x - edge) > 0) & F.lit(edge != median)
        flags.append(F.coalesce(flag, F.lit(False)).alias(name))
    return table.select(*[F.col(f"`{c}`") for c in table.columns], *flags)


def robust_mask(table: DataFrame, metric: str, high: bool = True, out: str = "outlier") -> DataFrame:
    return robust_masks(table, [(metric, high, out)])


def robust_scores(table: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Adds outlier_score, the largest |z| over the metrics, and top_metric, which one it is (the first on ties; 0 and ""
    where no metric has a value). Metrics without spread are ignored."""
    table = cut(table)
    found = _spread(table, metrics, [0.5])
    z = [(i, m, F.abs(MAD_SCALE * (finite(F.col(f"`{m}`").cast("double")) - found[m][1][0]) / found[m][2])) for i, m in enumerate(metrics) if found[m][0] and found[m][2] > MAD_EPS]
    none = F.struct(F.lit(None).cast("double").alias("z"), F.lit(0).alias("i"), F.lit("").alias("m"))
    best = F.array_max(F.filter(F.array(none, *[F.struct(x.alias("z"), F.lit(-i).alias("i"), F.lit(m).alias("m")) for i, m, x in z]), lambda s: s["z"].isNotNull()))
    return table.select(*[F.col(f"`{c}`") for c in table.columns], F.coalesce(best["z"], F.lit(0.0)).alias("outlier_score"), F.coalesce(best["m"], F.lit("")).alias("top_metric"))


def guarded_corr(a: Column, b: Column) -> Column:
    """Pearson over pairs that are both finite; null under 3 pairs or without spread."""
    both = finite(a).isNotNull() & finite(b).isNotNull()
    x, y = F.when(both, a), F.when(both, b)
    return F.when((F.count(x) >= 3) & (F.stddev_pop(x) > 1e-12) & (F.stddev_pop(y) > 1e-12), F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)))


def rmse(d: Column) -> Column:
    v = finite(d)
    return F.sqrt(F.avg(v * v))


def weighted_mean(x: str, weight: str) -> Column:
    return F.sum(F.col(x) * F.col(weight)) / F.greatest(F.sum(weight), F.lit(1))


def first_by(label: Column, value: Column, tie: Column) -> Column:
    """The label of the largest value; the smallest tie wins."""
    return F.max_by(label, F.struct(value, -tie))


def least_by(label: Column, value: Column, tie: Column) -> Column:
    return F.min_by(label, F.struct(value, tie))


def histogram(table: DataFrame, metric: str, low: float, high: float, bins: int) -> DataFrame:
    """bin (0 on), count; the last bin holds its upper edge; values outside are left out."""
    x = F.col(metric)
    place = F.least(F.floor((x - low) / ((high - low) / bins)), F.lit(bins - 1)).cast("int")
    return table.where(x.between(low, high)).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("count"))


def crosstab(table: DataFrame, row: str, column: str, values: Sequence | None = None, top: int = 24) -> DataFrame:
    """Counts with the rows of the largest totals; ties go to the smaller row."""
    wide = table.groupBy(row).pivot(column, values).agg(F.count(F.lit(1))).na.fill(0)
    counts = [F.col(f"`{c}`") for c in wide.columns if c != row]
    return wide.withColumn("total", sum(counts[1:], counts[0])).orderBy(F.desc("total"), row).limit(top)


def vector_stats(frames: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """dim, mean, std, min, max, q01, q99 over all frames, NaN-skipping."""
    long = frames.select(*by, F.posexplode(column).alias("dim", "x"))
    return summaries(long, [*by, "dim"], F.col("x"), "x", ("mean", "std", "min", "max", "p1", "p99")).withColumnsRenamed({"x_mean": "mean", "x_std": "std", "x_min": "min", "x_max": "max", "x_p1": "q01", "x_p99": "q99"})


def mean_of_numeric(table: DataFrame, by: Sequence[str]) -> DataFrame:
    """Means of all numeric columns per group, nulls and NaN skipped."""
    numeric = [f.name for f in table.schema if f.name not in by and f.dataType.typeName() in ("integer", "long", "double", "float", "short", "byte")]
    return table.groupBy(*by).agg(*[F.avg(finite(F.col(f"`{c}`").cast("double"))).alias(c) for c in numeric])


def pca2(table: DataFrame, key: str, metrics: Sequence[str]) -> DataFrame:
    """Two principal components of the standardised metrics, medians for missing values. Signs: the largest loading of a
    component is positive. The moments are aggregated; only a metrics x metrics matrix is solved on the driver."""
    import numpy as np

    table = cut(table.select(key, *metrics))
    medians = whole(table, {m: F.col(m) for m in metrics}, [0.5])
    filled = table.select(key, *[F.coalesce(finite(F.col(m)), F.lit(medians[m][1][0] if medians[m][0] else 0.0)).alias(m) for m in metrics])
    stats = filled.agg(*[F.avg(m).alias(f"a_{m}") for m in metrics], *[F.stddev_pop(m).alias(f"s_{m}") for m in metrics]).first()
    mean, scale = {m: stats[f"a_{m}"] or 0.0 for m in metrics}, {m: max(stats[f"s_{m}"] or 0.0, 1e-8) for m in metrics}
    z = filled.select(key, *[((F.col(m) - mean[m]) / scale[m]).alias(m) for m in metrics])
    pairs = [(i, j) for i in range(len(metrics)) for j in range(i, len(metrics))]
    got = z.agg(*[F.avg(F.col(metrics[i]) * F.col(metrics[j])).alias(f"c{i}_{j}") for i, j in pairs]).first()
    cov = np.zeros((len(metrics),) * 2)
    for i, j in pairs:
        cov[i, j] = cov[j, i] = got[f"c{i}_{j}"] or 0.0
    load = np.linalg.eigh(cov)[1][:, ::-1][:, :2]
    load = load * np.where(load[np.abs(load).argmax(axis=0), np.arange(load.shape[1])] < 0, -1, 1)
    part = lambda k: sum((F.col(m) * float(load[i, k]) for i, m in enumerate(metrics)), F.lit(0.0))
    return z.select(key, part(0).alias("pc1"), part(1).alias("pc2"))
