"""Operators over the frames of an episode, in order. They share one window, so Spark sorts each episode once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motionloom.functions.vectors import finite, minus, norm, scaled
from motionloom.operators.ranks import in_order
from motionloom.operators.stats import guarded_corr

EPISODE, FRAME = "episode_index", "frame_index"


def order(episode: str = EPISODE, frame: str = FRAME):
    return Window.partitionBy(episode).orderBy(frame)


def steps(frames: DataFrame, vector: Column, out: str, episode: str = EPISODE, frame: str = FRAME) -> DataFrame:
    """Adds the length of the step from the frame before; null on the first."""
    return frames.withColumn(out, norm(minus(vector, F.lag(vector).over(order(episode, frame)))))


def derivatives(frames: DataFrame, vector: Column, fps: float, prefix: str, episode: str = EPISODE, frame: str = FRAME) -> DataFrame:
    """Adds the lengths of velocity, acceleration and jerk: differences times the rate, applied one to three times."""
    at = order(episode, frame)
    now, made = vector, frames
    for name in ("velocity", "acceleration", "jerk"):
        made = made.withColumn(f"__{name}", scaled(minus(now, F.lag(now).over(at)), fps)).withColumn(f"{prefix}_{name}_l2", norm(F.col(f"__{name}")))
        now = F.col(f"__{name}")
    return made.drop("__velocity", "__acceleration", "__jerk")


def longest_run(frames: DataFrame, flag: Column, episode: str = EPISODE, frame: str = FRAME) -> DataFrame:
    """Episode, run: the largest number of frames in a row for which flag holds (0 if none)."""
    rows = frames.select(episode, frame, F.coalesce(flag, F.lit(False)).alias("on"))
    island = F.row_number().over(order(episode, frame)) - F.row_number().over(Window.partitionBy(episode, "on").orderBy(frame))
    runs = rows.withColumn("island", island).groupBy(episode, "on", "island").agg(F.count(F.lit(1)).alias("n"))
    return runs.groupBy(episode).agg(F.max(F.when(F.col("on"), F.col("n")).otherwise(0)).alias("run"))


def shifted(frames: DataFrame, a: Column, b: Column, lags: int, episode: str = EPISODE, frame: str = FRAME) -> DataFrame:
    """Episode, lag, a, b: a at t beside b at t + lag, for every lag from -lags to lags. One window over the frames brings each its
    neighbours; they are dealt by episode already when they are counted by episode and lag."""
    near = Window.partitionBy(episode).orderBy("t").rangeBetween(-lags, lags)
    rows = frames.select(episode, F.col(frame).cast("bigint").alias("t"), a.alias("a"), b.alias("b"))
    beside = rows.select(episode, "t", "a", F.collect_list(F.struct("t", "b")).over(near).alias("near")).select(episode, "t", "a", F.explode("near").alias("o"))
    return beside.select(episode, (F.col("o.t") - F.col("t")).cast("int").alias("lag"), "a", F.col("o.b").alias("b"))


def lag_by_correlation(frames: DataFrame, a: Column, b: Column, lags: int = 20, least: int = 4, episode: str = EPISODE) -> DataFrame:
    """Episode, lag, corr: the shift of b against a with the largest correlation; the smallest lag on ties; positive: b trails."""
    pairs = shifted(frames, a, b, lags, episode).where("a IS NOT NULL AND b IS NOT NULL")
    each = pairs.groupBy(episode, "lag").agg(F.count(F.lit(1)).alias("n"), guarded_corr(F.col("a"), F.col("b")).alias("corr")).where((F.col("n") >= least) & F.col("corr").isNotNull())
    return each.groupBy(episode).agg(F.max_by("lag", F.struct(F.round("corr", 9), -F.col("lag"))).alias("lag"), F.max("corr").alias("corr"))


def lag_by_rmse(frames: DataFrame, a: Column, b: Column, lags: int = 20, least: int = 2, episode: str = EPISODE) -> DataFrame:
    """Episode, lag, rmse over all components of two vectors: the smallest error; the smallest lag on ties."""
    pairs = shifted(frames, a, b, lags, episode)
    sq = F.aggregate(minus(F.col("a"), F.col("b")), F.lit(0.0), lambda s, x: s + x * x)
    each = pairs.select(episode, "lag", sq.alias("sq"), F.size("a").alias("w")).groupBy(episode, "lag").agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.sum("sq") / F.sum("w")).alias("rmse")).where(F.col("n") >= least)
    return each.groupBy(episode).agg(F.min_by("lag", F.struct(F.round("rmse", 9), F.col("lag"))).alias("lag"), F.min("rmse").alias("rmse"))


def tail(frames: DataFrame, share: float = 0.2, episode: str = EPISODE, frame: str = FRAME) -> DataFrame:
    """The last frames of each episode: those from place int((1 - share) n) on."""
    n = F.count(F.lit(1)).over(Window.partitionBy(episode))
    place = F.row_number().over(order(episode, frame)) - 1
    return frames.withColumns({"__n": n, "__p": place}).where(F.col("__p") >= F.floor(F.col("__n") * F.lit(1 - share))).drop("__n", "__p")


def downsample(frames: DataFrame, k: int, how: str = "truncate", episode: str = EPISODE, frame: str = FRAME) -> DataFrame:
    """At most k frames per episode, evenly spaced from first to last. how: "truncate" or "round" (half to even)."""
    n = F.count(F.lit(1)).over(Window.partitionBy(episode))
    place = F.row_number().over(order(episode, frame)) - 1
    spot = lambda i, m: (m - 1) * i / F.lit(float(max(1, k - 1)))
    cut = (lambda x: F.floor(x)) if how == "truncate" else (lambda x: F.bround(x))
    wanted = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: cut(spot(i, F.col("__n"))).cast("bigint"))
    return frames.withColumns({"__n": n, "__p": place}).where((F.col("__n") <= k) | F.array_contains(wanted, F.col("__p").cast("bigint"))).drop("__n", "__p")


def contiguity(rows: DataFrame, group: str, index: str, stored: str | None = None) -> DataFrame:
    """Group, n, contiguous: whether index is 0..n-1, in the order of the column `stored` where one is named, else in any order."""
    if stored is not None:
        right = F.col(index).eqNullSafe(F.row_number().over(order(group, stored)) - 1)
        return rows.select(group, right.alias("__ok")).groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.bool_and("__ok").alias("contiguous"))
    return rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"), ((F.min(index) == 0) & (F.max(index) == F.count(F.lit(1)) - 1) & (F.count_distinct(index) == F.count(F.lit(1)))).alias("contiguous"))


def vector_fingerprint(frames: DataFrame, column: str, episode: str = EPISODE, frame: str = FRAME, chunk: int = 4096) -> DataFrame:
    """Episode, frames, fingerprint: SHA-256 of an episode's vectors in frame order, to six digits.

    A tree of two levels, so that no group holds more than hashes: frames are hashed by themselves, then by chunk, then by
    episode. Null vectors count as empty and non-finite values as null; frames of equal number are ordered by hash."""
    whole = F.transform(F.coalesce(F.col(column), F.array().cast("array<double>")), lambda x: F.coalesce(F.floor(finite(x) * 1e6 + 0.5).cast("string"), F.lit("null")))
    own = frames.select(episode, F.col(frame).alias("__f"), F.sha2(F.array_join(whole, ","), 256).alias("__h")).withColumn("__c", F.floor(F.col("__f") / chunk))
    joined = lambda at: F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at, "__h"))), lambda s: s["__h"]), ","), 256)
    parts = own.groupBy(episode, "__c").agg(F.count(F.lit(1)).alias("__n"), joined("__f").alias("__h"))
    return parts.groupBy(episode).agg(F.sum("__n").alias("frames"), joined("__c").alias("fingerprint"))


def done_only_last(rows: DataFrame, group: str, index: str, done: Column) -> DataFrame:
    """Group, done_ok: done holds on the last row and on no other."""
    last = F.lead(index).over(order(group, index)).isNull()
    return rows.select(group, (done.eqNullSafe(last)).alias("ok")).groupBy(group).agg(F.bool_and("ok").alias("done_ok"))


def offsets(lengths: DataFrame, key: str, length: str) -> DataFrame:
    """Key, length, start: rows of all keys before. Keys are dealt into ranges, and only range totals meet."""
    return in_order(lengths.select(key, length), F.col(key), number="__number", totals={"start": length}).drop("__number")


def trim(frames: DataFrame, start: int, end: int, fps: float, episode: str = EPISODE, frame: str = FRAME) -> DataFrame:
    """Frames start..end inclusive, renumbered from 0, with timestamp and done made anew."""
    kept = frames.where(F.col(frame).between(start, end))
    at = order(episode, frame)
    kept = kept.withColumns({"__i": (F.row_number().over(at) - 1).cast("bigint"), "__last": F.lead(frame).over(at).isNull()})
    return kept.withColumns({frame: F.col("__i"), "timestamp": F.col("__i") / F.lit(float(fps)), "done": F.col("__last")}).drop("__i", "__last")


def video_ordinals(records: DataFrame, camera: str, path: str, index: str, record: str) -> DataFrame:
    """Camera, path, index, ordinal: first record of each frame, numbered per file by (record, index)."""
    first = records.groupBy(camera, path, index).agg(F.min(record).alias("__r"))
    return first.withColumn("ordinal", (F.row_number().over(Window.partitionBy(camera, path).orderBy("__r", index)) - 1).cast("bigint")).drop("__r")


def savgol(frames: DataFrame, x: str, out: str, window: int = 7, episode: str = EPISODE, frame: str = FRAME) -> DataFrame:
    """Savitzky-Golay of degree 2: a fitted parabola's value in the middle of the window, at the ends that of the first or
    last window. The window shrinks to the largest odd number of frames that an episode has; under 5 frames nothing changes."""
    at = order(episode, frame)
    n = F.count(F.lit(1)).over(Window.partitionBy(episode))
    place = F.row_number().over(at) - 1
    made = frames.withColumns({"__n": n, "__p": place})
    result = F.col(x)
    for w in range(5, window + 1, 2):
        half = w // 2
        whole = F.collect_list(x).over(Window.partitionBy(episode).orderBy(frame).rowsBetween(-(w - 1), w - 1))
        low = F.greatest(F.col("__p") - (w - 1), F.lit(0))
        begin = F.greatest(F.lit(0), F.least(F.col("__p") - half, F.col("__n") - w))
        values = F.slice(F.col(f"__w{w}"), (begin - low + 1).cast("int"), w)
        row = F.array(*[F.array(*map(F.lit, r)) for r in savgol_rows(w)])[(F.col("__p") - begin).cast("int")]
        made = made.withColumn(f"__w{w}", whole)
        fits = (F.col("__n") >= w) if w == window else ((F.col("__n") >= w) & (F.col("__n") < w + 2))
        result = F.when(fits, F.aggregate(F.zip_with(values, row, lambda a, b: a * b), F.lit(0.0), lambda s, y: s + y)).otherwise(result)
    return made.withColumn(out, result).drop("__n", "__p", *[f"__w{w}" for w in range(5, window + 1, 2)])


def savgol_rows(window: int, degree: int = 2) -> list[list[float]]:
    """Row i: the weights that give the fitted polynomial at place i of the window; least squares."""
    import numpy as np

    t = np.arange(window) - window // 2
    basis = np.vander(t, degree + 1, increasing=True).astype(float)
    return (basis @ np.linalg.pinv(basis)).tolist()
