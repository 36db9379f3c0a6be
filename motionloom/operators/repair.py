"""Inspection and gated repair of positions whose axes were written in another frame, and the diagnosis of alignment.

A repair has four steps: inspect every episode, gate on the inspection, map the actions, inspect again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motionloom.functions.vectors import finite
from motionloom.operators.mapping import best_axis_permutation
from motionloom.operators.sequences import lag_by_rmse
from motionloom.operators.stats import guarded_corr

# The axis order that the raw frame needs, and the limits of the checks.
EXPECTED_PERM, EXPECTED_SIGNS = (2, 0, 1), (1, 1, 1)
OFFSET_RMSE, SUSPICIOUS_RATIO, MAX_LAG = 0.04, 0.60, 20


def mapped(position: Column, perm: Sequence[int] = EXPECTED_PERM, signs: Sequence[int] = EXPECTED_SIGNS) -> Column:
    """The position with its axes permuted and signed."""
    return F.array(*[position[p] * F.lit(float(s)) for p, s in zip(perm, signs, strict=True)])


def _rmse(pairs: Sequence[tuple[Column, Column]], offset: bool) -> Column:
    """Over all frames and axes of a group whose difference is finite; offset: after the mean difference of each axis is taken off."""
    gaps = [finite(a - b) for a, b in pairs]
    squares = [F.coalesce(F.var_pop(g) * F.count(g) if offset else F.sum(g * g), F.lit(0.0)) for g in gaps]
    number = sum((F.count(g) for g in gaps[1:]), F.count(gaps[0]))
    return F.when(number > 0, F.sqrt(sum(squares[1:], squares[0]) / number))


def inspect_positions(frames: DataFrame, state: str, action: str, key: str = "episode_index") -> DataFrame:
    """Key, frames, direct_rmse, expected_rmse, expected_offset_rmse, corr_diag_mean, best_perm, best_signs, best_rmse,
    best_is_expected, best_is_identity: one aggregation for the errors, and one of moments for the best permutation."""
    s, a = [F.col(state)[i] for i in range(3)], [F.col(action)[i] for i in range(3)]
    m = [a[p] * F.lit(float(x)) for p, x in zip(EXPECTED_PERM, EXPECTED_SIGNS, strict=True)]
    corr = F.array_compact(F.array(*[guarded_corr(x, y) for x, y in zip(s, m, strict=True)]))
    errors = frames.groupBy(F.col(key).alias("ik")).agg(
        F.count(F.lit(1)).alias("frames"), _rmse(list(zip(s, a, strict=True)), False).alias("direct_rmse"), _rmse(list(zip(s, m, strict=True)), False).alias("expected_rmse"),
        _rmse(list(zip(s, m, strict=True)), True).alias("expected_offset_rmse"), corr.alias("corr"),
    )
    best = best_axis_permutation(frames, state, action, key)
    joined = best.join(errors, F.col(key) == F.col("ik"))
    text = lambda v: "".join(map(str, v))
    return joined.select(
        key, "frames", "direct_rmse", "expected_rmse", "expected_offset_rmse", (F.aggregate("corr", F.lit(0.0), lambda t, x: t + x) / F.when(F.size("corr") > 0, F.size("corr"))).alias("corr_diag_mean"),
        F.col("perm").alias("best_perm"), F.col("signs").alias("best_signs"), F.col("rmse").alias("best_rmse"),
        ((F.col("perm") == text(EXPECTED_PERM)) & (F.col("signs") == "+++")).alias("best_is_expected"), ((F.col("perm") == "012") & (F.col("signs") == "+++")).alias("best_is_identity"),
    )


def mapping_summary(inspected: DataFrame, by: str) -> DataFrame:
    """Per group: episodes, shares of episodes whose best map is the expected one or none, mean errors, the largest best
    error, and the most frequent best map (of equally frequent ones the first in order)."""
    mode = lambda c, out: F.mode(F.col(c), deterministic=True).alias(out)
    return inspected.groupBy(by).agg(
        F.count(F.lit(1)).alias("episodes"), F.avg(F.col("best_is_expected").cast("double")).alias("expected_ratio"), F.avg(F.col("best_is_identity").cast("double")).alias("identity_ratio"),
        F.avg("direct_rmse").alias("direct_rmse_mean"), F.avg("expected_rmse").alias("expected_rmse_mean"), F.avg("expected_offset_rmse").alias("expected_offset_rmse_mean"),
        F.avg("best_rmse").alias("best_rmse_mean"), F.max("best_rmse").alias("best_rmse_max"), F.avg("corr_diag_mean").alias("corr_diag_mean"), mode("best_perm", "best_perm"), mode("best_signs", "best_signs"),
    )


def refused(inspected: DataFrame, limit: float = OFFSET_RMSE) -> DataFrame:
    """The inspected episodes that forbid a repair: an error after the expected map beyond the limit, or none at all."""
    error = F.col("expected_offset_rmse")
    return inspected.where(error.isNull() | F.isnan(error) | (error > limit))


def repair_positions(frames: DataFrame, inspected: DataFrame, action: str, first: int = 0, limit: float = OFFSET_RMSE) -> DataFrame:
    """frames with the three action components from `first` on mapped as expected, no offset added. All or nothing: any
    refused episode raises, and the frames stay as they are."""
    bad = refused(inspected, limit).count()
    if bad:
        raise ValueError(f"{bad} episodes are further than {limit} from the expected axes; nothing was repaired")
    v = F.col(action)
    new = F.concat(F.slice(v, 1, first), mapped(F.slice(v, first + 1, 3)), F.slice(v, F.lit(first + 4), F.greatest(F.size(v) - first - 3, F.lit(0))))
    return frames.withColumn(action, new)


def attach_best(tasks: DataFrame, inspected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """tasks with their inspection; raises if any task has none."""
    missing = tasks.join(inspected, list(keys), "left_anti").count()
    if missing:
        raise KeyError(f"{missing} episodes were not inspected")
    return tasks.join(inspected, list(keys))


def alignment_diagnosis(frames: DataFrame, state: str, action: str, key: str = "episode_index", frame: str = "frame_index", ratio: float = SUSPICIOUS_RATIO, most: int = MAX_LAG) -> DataFrame:
    """Key, frames, direct_rmse, offset_rmse, best_lag, best_lag_rmse, best_perm, best_signs, best_perm_rmse, direct_ratio,
    offset_ratio, is_identity, suspected: a map other than none that brings the error to `ratio` of the direct one or less."""
    s, a = [F.col(state)[i] for i in range(3)], [F.col(action)[i] for i in range(3)]
    pairs = list(zip(s, a, strict=True))
    errors = frames.groupBy(F.col(key).alias("dk")).agg(F.count(F.lit(1)).alias("frames"), _rmse(pairs, False).alias("direct_rmse"), _rmse(pairs, True).alias("offset_rmse"))
    best = best_axis_permutation(frames, state, action, key).select(F.col(key).alias("bk"), F.col("perm").alias("best_perm"), F.col("signs").alias("best_signs"), F.col("rmse").alias("best_perm_rmse"))
    lags = lag_by_rmse(frames, F.slice(action, 1, 3), F.slice(state, 1, 3), most).select(F.col(key).alias("lk"), F.col("lag").alias("best_lag"), F.col("rmse").alias("best_lag_rmse"))
    over = lambda c: F.when(F.col(c) > 0, F.col("best_perm_rmse") / F.col(c))
    same = (F.col("best_perm") == "012") & (F.col("best_signs") == "+++")
    joined = errors.join(best, F.col("dk") == F.col("bk")).join(lags, F.col("dk") == F.col("lk"), "left")
    return joined.select(F.col("dk").alias(key), "frames", "direct_rmse", "offset_rmse", "best_lag", "best_lag_rmse", "best_perm", "best_signs", "best_perm_rmse", over("direct_rmse").alias("direct_ratio"), over("offset_rmse").alias("offset_ratio"), same.alias("is_identity"), F.coalesce(~same & (over("direct_rmse") <= ratio), F.lit(False)).alias("suspected"))
