"""Hand metrics of an episode, over the components of the finger angles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motionloom.functions.vectors import finite, minus, scaled, total
from motionloom.operators.sequences import longest_run

# Fixed values of the published quality standard.
ZERO, SATURATED, TAIL, CLOSING_QUANTILE = 1e-6, 0.98, 0.8, 0.75
METRICS = ("finger_angle_min", "finger_angle_max", "finger_angle_mean", "finger_angle_std", "finger_velocity_p95", "finger_acceleration_p95", "zero_ratio", "saturation_ratio", "closing_duration", "holding_stability")


def hand_metrics(frames: DataFrame, hand: Column, fps: float, key: str = "episode_index", frame: str = "frame_index", saturated: float = SATURATED) -> DataFrame:
    """Key and METRICS, one row per episode. Everything is over finite components: range, mean and spread of the angles, the
    95th percentiles of their absolute velocities and accelerations, the shares near zero and near the stop, the longest
    time in which the mean velocity is above the episode's upper quartile of it, and the mean spread of the last fifth.

    Null where nothing is finite; an episode of one frame has closing_duration 0. An empty table gives an empty result."""
    at, whole = Window.partitionBy(key).orderBy(frame), Window.partitionBy(key)
    f = frames.select(key, frame, hand.alias("h"))
    f = f.withColumn("v", scaled(minus(F.col("h"), F.lag("h").over(at)), fps))
    f = f.withColumn("a", scaled(minus(F.col("v"), F.lag("v").over(at)), fps)).withColumn("late", F.row_number().over(at) - 1 >= F.floor(F.count(F.lit(1)).over(whole) * F.lit(TAIL)))
    none = F.transform("h", lambda x: F.lit(None).cast("double"))  # arrays_zip would drop the first frames
    each = f.select(key, "late", F.posexplode(F.arrays_zip("h", F.coalesce("v", none).alias("v"), F.coalesce("a", none).alias("a"))).alias("dim", "x"))
    each = each.select(key, "late", "dim", finite(F.col("x.h")).alias("h"), finite(F.abs("x.v")).alias("v"), finite(F.abs("x.a")).alias("a"))
    share = lambda c: F.avg(F.when(F.col("h").isNotNull(), c.cast("double")))
    values = each.groupBy(key).agg(
        F.min("h").alias("finger_angle_min"), F.max("h").alias("finger_angle_max"), F.avg("h").alias("finger_angle_mean"), F.stddev_pop("h").alias("finger_angle_std"),
        F.percentile("v", F.lit(0.95)).alias("finger_velocity_p95"), F.percentile("a", F.lit(0.95)).alias("finger_acceleration_p95"),
        share(F.abs("h") <= ZERO).alias("zero_ratio"), share(F.abs("h") >= saturated).alias("saturation_ratio"),
    )
    hold = each.where("late").groupBy(key, "dim").agg(F.stddev_pop("h").alias("s")).groupBy(F.col(key).alias("hk")).agg(F.avg("s").alias("holding_stability"))
    pace = f.select(key, frame, (total(F.col("v")) / F.size("v")).alias("pace"))
    limit = F.greatest(F.lit(1e-6), F.percentile(F.abs("pace"), F.lit(CLOSING_QUANTILE)).over(whole))
    runs = longest_run(pace.withColumn("limit", limit), F.col("pace") > F.col("limit")).select(F.col(key).alias("rk"), (F.col("run") / F.lit(fps)).alias("closing_duration"))
    joined = values.join(hold, F.col(key) == F.col("hk"), "left").join(runs, F.col(key) == F.col("rk"), "left")
    return joined.withColumn("closing_duration", F.coalesce("closing_duration", F.lit(0.0))).select(key, *METRICS)
