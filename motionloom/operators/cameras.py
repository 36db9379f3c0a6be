"""Cameras of an export: which ones, under which names, and whether each step has a frame of every one."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The prefix of a camera's feature, a camera with a short name of its own.
FEATURE_PREFIX = "observation.images."
SHORT_NAMES = {"wrist_d405_rgb": "wrist_view"}


@dataclass(frozen=True)
class Camera:
    name: str
    alias: str
    feature: str


def _one_each(values: Sequence[str], names: Sequence[str], what: str) -> list[str]:
    kept = [v.strip() for v in values]
    if len(kept) != len(names) or not all(kept):
        raise ValueError(f"as many {what} as cameras are needed, none of them blank: {kept}")
    return kept


def resolve(cameras: Sequence[str], aliases: Sequence[str] | None = None, features: Sequence[str] | None = None, main: str | None = None, main_alias: str | None = None, main_feature: str | None = None) -> list[Camera]:
    """The cameras in order, the first being the one whose shape must not change.

    Blank names are left out; none left, or two of a kind (names, aliases, features), raise ValueError, as do lists of another
    length. Without a list, an alias is main_alias for the main camera (its name if blank), a short name where there is one,
    else the camera's name; a feature is main_feature for the main camera, else the alias behind a prefix."""
    names = [c.strip() for c in cameras if c.strip()]
    if not names:
        raise ValueError("no camera is selected")
    main = names[0] if main is None else main
    shorts = _one_each(aliases, names, "aliases") if aliases is not None else [((main_alias or "").strip() or n) if n == main else SHORT_NAMES.get(n, n) for n in names]
    keys = _one_each(features, names, "features") if features is not None else [((main_feature or "").strip() if n == main else "") or FEATURE_PREFIX + a for n, a in zip(names, shorts, strict=True)]
    for what, values in (("names", names), ("aliases", shorts), ("features", keys)):
        if len(set(values)) < len(values):
            raise ValueError(f"the {what} of cameras must differ: {values}")
    return [Camera(*x) for x in zip(names, shorts, keys, strict=True)]


def with_ordinals(steps: DataFrame, ordinals: DataFrame, camera: str, path: str, index: str, key: Sequence[str] = ()) -> DataFrame:
    """steps with ordinal, the place of the named frame in its file, and video_reason: missing_video where a field is null or
    the file has no such frame, else null. ordinals: key, camera, path, index, ordinal, one row per frame. Every step stays."""
    names = [*key, camera, path, index]
    own = ordinals.select(*[F.col(f"`{n}`").alias(f"__o{i}") for i, n in enumerate(names)], "ordinal")
    same = F.lit(True)
    for i, n in enumerate(names):
        same = same & (F.col(f"`{n}`") == F.col(f"__o{i}"))
    joined = steps.join(own, same, "left")
    return joined.select(*[F.col(f"`{c}`") for c in steps.columns], "ordinal", F.when(F.col("ordinal").isNull(), F.lit("missing_video")).alias("video_reason"))


def shape_breaks(frames: DataFrame, key: str, step: str, height: str = "height", width: str = "width") -> DataFrame:
    """Episodes that change the shape of their main camera's frames: key, reason (inconsistent_video_shape)."""
    first = F.min_by(F.struct(height, width), step)
    shapes = frames.where(F.col(height).isNotNull() & F.col(width).isNotNull()).groupBy(key).agg(first.alias("first"), F.min(F.struct(height, width)).alias("least"), F.max(F.struct(height, width)).alias("most"))
    return shapes.where("least <> most").select(key, F.lit("inconsistent_video_shape").alias("reason"))


def whole_steps(steps: DataFrame, key: Sequence[str], cameras: Sequence[str], camera: str = "camera_name", reason: Column | None = None) -> DataFrame:
    """key of the steps that have a frame without a reason from every one of the cameras, once or more."""
    good = (F.col("video_reason") if reason is None else reason).isNull() & F.col(camera).isin(*cameras)
    return steps.where(good).groupBy(*key).agg(F.count_distinct(camera).alias("n")).where(F.col("n") == len(set(cameras))).drop("n")
