"""As-of alignment of recorded streams by union and fill: O(n log n) per episode, one sort, no range join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLACK = 1e-9


def matched(targets: DataFrame, streams: Mapping[str, tuple[DataFrame, str]], key: str, ts: str, record_no: str) -> DataFrame:
    """Adds {name}_no, {name}_ts and {name}_dt (record minus target) of every stream's matching record to every target.

    One union, one shuffle and one sort serve all streams. At equal instants records stand before targets, so the last one so
    far is the match or the one before; the one after is the next that isn't null, found by an offset and not by a frame that
    reaches to the end, which would be read anew for every row."""
    t = targets.select(F.col(key), F.col(ts), F.struct(*[F.col(f"`{c}`") for c in targets.columns]).alias("__id"), F.lit(None).cast("bigint").alias("__no"), F.lit(len(streams)).alias("__side"))
    both = t
    for side, (records, _) in enumerate(streams.values()):
        first = records.where(F.col(ts).isNotNull()).groupBy(F.col(key), F.col(ts)).agg(F.min(record_no).cast("bigint").alias("__no"))
        both = both.unionByName(first.select(key, ts, F.lit(None).cast(t.schema["__id"].dataType).alias("__id"), "__no", F.lit(side).alias("__side")))
    w = Window.partitionBy(key).orderBy(ts, "__side")
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = both.withColumns({f"__r{i}": F.when(F.col("__side") == i, F.struct(F.col(ts).alias("ts"), F.col("__no").alias("no"))) for i in range(len(streams))})
    over = f"OVER (PARTITION BY `{key}` ORDER BY `{ts}`, __side)"
    got = both.select("*", *[F.last(f"__r{i}", ignorenulls=True).over(so_far).alias(f"__b{i}") for i in range(len(streams))], *[F.expr(f"lead(__r{i}, 1) IGNORE NULLS {over}").alias(f"__a{i}") for i in range(len(streams))])
    out = []
    for i, (name, (_, how)) in enumerate(streams.items()):
        back, ahead = F.col(f"__b{i}"), F.col(f"__a{i}")
        db, da = F.col(ts) - back["ts"], ahead["ts"] - F.col(ts)
        best = F.when(ahead.isNull(), back).when(back.isNull(), ahead).when((db < da) | ((db == da) & (back["no"] <= ahead["no"])), back).otherwise(ahead)
        if how == "future":
            best = F.when((db <= SLACK) & back.isNotNull(), back).when(ahead.isNotNull(), ahead).otherwise(best)
        out += [best["no"].alias(f"{name}_no"), best["ts"].alias(f"{name}_ts"), (best["ts"] - F.col(ts)).alias(f"{name}_dt")]
    return got.where(F.col("__side") == len(streams)).select("__id.*", *out)


def asof(targets: DataFrame, records: DataFrame, key: str, ts: str, record_no: str, how: str = "nearest", prefix: str = "m") -> DataFrame:
    """Adds {prefix}_no, {prefix}_ts and {prefix}_dt (record minus target) of the matching record to every target.

    nearest: smallest |dt|, the earliest record in log order on ties. future: the first record at most 1e-9 s before the
    target or later, else the nearest. Targets without any record of their key keep nulls. Records without a time never match."""
    return matched(targets, {prefix: (records, how)}, key, ts, record_no)


def grid(streams: Sequence[DataFrame], key: str, ts: str, fps: float) -> DataFrame:
    """Key, step, ts: instants from the latest first record to the earliest last record of all streams, one per 1 / fps.
    Keys that lack a stream, or whose streams do not overlap, have none."""
    bounds = None
    for i, s in enumerate(streams):
        own = s.groupBy(F.col(key).alias(f"k{i}")).agg(F.min(ts).alias(f"lo{i}"), F.max(ts).alias(f"hi{i}"))
        bounds = own if bounds is None else bounds.join(own, F.col("k0") == F.col(f"k{i}"))
    n = len(streams)
    lo, hi = (F.greatest(*[F.col(f"lo{i}") for i in range(n)]), F.least(*[F.col(f"hi{i}") for i in range(n)])) if n > 1 else (F.col("lo0"), F.col("hi0"))
    spans = bounds.select(F.col("k0").alias(key), lo.alias("lo"), hi.alias("hi")).where("hi > lo")
    count = ((F.col("hi") - F.col("lo")) * fps).cast("bigint")
    return spans.select(key, "lo", F.explode(F.sequence(F.lit(0).cast("bigint"), count)).alias("step")).select(key, "step", (F.col("lo") + F.col("step") / F.lit(float(fps))).alias(ts))


def align(grid_rows: DataFrame, streams: dict[str, tuple[DataFrame, str]], key: str, ts: str, record_no: str, tolerance: float = 0.1) -> DataFrame:
    """The grid with each stream's match ({name}_no, {name}_dt) and a reason: the first stream out of tolerance, or ok."""
    out = matched(grid_rows, streams, key, ts, record_no).drop(*[f"{name}_ts" for name in streams])
    reason = F.lit("ok")
    for name in reversed(list(streams)):
        reason = F.when(F.col(f"{name}_no").isNull() | (F.abs(f"{name}_dt") > tolerance), F.lit(f"{name}_out_of_tolerance")).otherwise(reason)
    return out.withColumn("reason", reason)


def camera_sync(primary: DataFrame, others: dict[str, DataFrame], key: str, ts: str, record_no: str) -> DataFrame:
    """Each record of the primary camera with the nearest of every other camera; dropped where one is missing; the instant
    is the mean of all timestamps."""
    out = matched(primary, {name: (records, "nearest") for name, records in others.items()}, key, ts, record_no)
    for name in others:
        out = out.where(F.col(f"{name}_no").isNotNull())
    times = [F.col(ts), *[F.col(f"{n}_ts") for n in others]]
    return out.withColumn("mean_ts", sum(times[1:], times[0]) / F.lit(float(len(times))))
