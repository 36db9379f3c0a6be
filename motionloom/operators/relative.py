"""Relative actions over horizons: offset self-joins as leads, bounds as a small joined table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motionloom.functions.vectors import dot, minus, normalised, rot6d_rows, rotation_between
from motionloom.operators.quantiles import percentiles
from motionloom.operators.sequences import order


def ahead(frames: DataFrame, column: str, horizons: Sequence[int], episode: str = "episode_index", frame: str = "frame_index") -> DataFrame:
    """One row per frame and horizon h for which frame t + h exists: episode, frame, horizon, now, then. One sort for all horizons."""
    at = order(episode, frame)
    pairs = [F.when(F.lead(column, h).over(at).isNotNull(), F.struct(F.lit(h).alias("horizon"), F.lead(column, h).over(at).alias("then"))) for h in horizons]
    rows = frames.select(episode, frame, F.col(column).alias("now"), F.array_compact(F.array(*pairs)).alias("pairs"))
    return rows.select(episode, frame, "now", F.explode("pairs").alias("p")).select(episode, frame, "p.horizon", "now", "p.then")


def ahead_of_state(frames: DataFrame, state: str, action: str, horizons: Sequence[int], episode: str = "episode_index", frame: str = "frame_index") -> DataFrame:
    """As `ahead`, with the state of frame t as now and the action h - 1 frames on, which leads to the state of t + h, as then."""
    at = order(episode, frame)
    pairs = [F.when(F.lead(action, h - 1).over(at).isNotNull(), F.struct(F.lit(h).alias("horizon"), F.lead(action, h - 1).over(at).alias("then"))) for h in horizons]
    rows = frames.select(episode, frame, F.col(state).alias("now"), F.array_compact(F.array(*pairs)).alias("pairs"))
    return rows.select(episode, frame, "now", F.explode("pairs").alias("p")).select(episode, frame, "p.horizon", "now", "p.then")


def relative_vector(pairs: DataFrame) -> DataFrame:
    """Adds rel: then - now."""
    return pairs.withColumn("rel", minus(F.col("then"), F.col("now")))


def relative_pose(now: Column, then: Column) -> Column:
    """xyz and rot6d (9 numbers each) -> struct of the move in the frame of now (array of 3) and the angle in degrees."""
    rows = rot6d_rows(F.slice(now, 4, 6))
    move = minus(F.slice(then, 1, 3), F.slice(now, 1, 3))
    # the transpose of the rotation times the move: sums over rows
    local = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.get(rows[0], i) * move[0] + F.get(rows[1], i) * move[1] + F.get(rows[2], i) * move[2])
    return F.struct(local.alias("move"), rotation_between(rows, rot6d_rows(F.slice(then, 4, 6))).alias("degrees"))


def bounds(pairs: DataFrame) -> DataFrame:
    """horizon, dim, q01, q99 of rel over all episodes."""
    long = pairs.select("horizon", F.posexplode("rel").alias("dim", "x"))
    return percentiles(long, ["horizon", "dim"], {"x": F.col("x")}, [0.01, 0.99]).select("horizon", "dim", F.get("ends", F.lit(0)).alias("q01"), F.get("ends", F.lit(1)).alias("q99"))


def against_bounds(pairs: DataFrame, limits: DataFrame, episode: str = "episode_index", frame: str = "frame_index") -> DataFrame:
    """One row per frame, horizon and dim: value, q01, q99, norm (-1 to 1 within the bounds), clipped."""
    long = pairs.select(episode, frame, "horizon", F.posexplode("rel").alias("dim", "value"))
    lim = limits.select(F.col("horizon").alias("h"), F.col("dim").alias("d"), "q01", "q99")
    joined = long.join(lim, (F.col("horizon") == F.col("h")) & (F.col("dim") == F.col("d"))).drop("h", "d")
    return joined.withColumn("norm", normalised(F.col("value"), F.col("q01"), F.col("q99"))).withColumn("clipped", F.abs("norm") > 1)


def clipped_rows(checked: DataFrame) -> DataFrame:
    """The values outside, with the side and the excess beyond the bound."""
    side = F.when(F.col("norm") < -1, "low").otherwise("high")
    excess = F.when(F.col("norm") < -1, F.col("q01") - F.col("value")).otherwise(F.col("value") - F.col("q99"))
    return checked.where("clipped").withColumns({"side": side, "excess": excess})


def clip_ratio(checked: DataFrame, by: Sequence[str] = ("episode_index",)) -> DataFrame:
    return checked.groupBy(*by).agg(F.sum(F.col("clipped").cast("bigint")).alias("clipped"), F.count(F.lit(1)).alias("values"), F.avg(F.col("clipped").cast("double")).alias("ratio"))


def path_metrics(frames: DataFrame, xyz: Column, episode: str = "episode_index", frame: str = "frame_index", pause: float = 1e-3) -> DataFrame:
    """Episode, path_length, displacement, straightness, pause_ratio."""
    from motionloom.functions.vectors import norm
    from motionloom.operators.sequences import steps

    moved = steps(frames.select(episode, frame, xyz.alias("p")), F.col("p"), "step", episode, frame)
    ends = moved.groupBy(episode).agg(F.sum("step").alias("path_length"), F.min_by("p", frame).alias("p0"), F.max_by("p", frame).alias("p1"), F.avg((F.col("step") < pause).cast("double")).alias("pause_ratio"))
    disp = norm(minus(F.col("p1"), F.col("p0")))
    return ends.select(episode, F.coalesce("path_length", F.lit(0.0)).alias("path_length"), disp.alias("displacement"), (disp / F.greatest(F.coalesce("path_length", F.lit(0.0)), F.lit(1e-8))).alias("straightness"), "pause_ratio")


def rot6d_validity(r: Column) -> Column:
    """Struct of how far the two axes are from unit length and from right angles."""
    a, b = F.slice(r, 1, 3), F.slice(r, 4, 3)
    return F.struct(F.abs(F.sqrt(dot(a, a)) - 1).alias("first"), F.abs(F.sqrt(dot(b, b)) - 1).alias("second"), F.abs(dot(a, b)).alias("product"))
