"""Incremental runs, manifests and date views: semi joins, anti joins and unions by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(log: DataFrame, key: str, line: str) -> DataFrame:
    """The last row of each key of an append-only log."""
    rest = [c for c in log.columns if c != key]
    return log.groupBy(key).agg(F.max_by(F.struct(*rest), line).alias("r")).select(key, "r.*")


def reusable(now: DataFrame, before: DataFrame, key: str, fingerprint: str) -> DataFrame:
    """Rows of now whose key and fingerprint were processed before."""
    return now.join(before.select(F.col(key).alias("__k"), F.col(fingerprint).alias("__f")), (F.col(key) == F.col("__k")) & (F.col(fingerprint) == F.col("__f")), "left_semi")


def to_do(now: DataFrame, before: DataFrame, key: str, fingerprint: str) -> DataFrame:
    return now.join(before.select(F.col(key).alias("__k"), F.col(fingerprint).alias("__f")), (F.col(key) == F.col("__k")) & (F.col(fingerprint) == F.col("__f")), "left_anti")


def merge_cached(cached: DataFrame, computed: DataFrame) -> DataFrame:
    return cached.unionByName(computed, allowMissingColumns=True)


def merge_manifest(old: DataFrame, new: DataFrame, kind: str = "item_type") -> DataFrame:
    """Rows of kinds that were refreshed are replaced, the others stay."""
    kinds = new.select(F.col(kind).alias("__t")).distinct()
    return old.join(kinds, F.col(kind) == F.col("__t"), "left_anti").unionByName(new)


def date_view(episodes: DataFrame, date: str = "source_date", length: str = "length", key: str = "episode_index") -> DataFrame:
    """Per date, without rows that have none: episodes, frames, chunks of 1000, first and last episode."""
    return episodes.where(F.col(date).isNotNull()).groupBy(date).agg(F.count(F.lit(1)).alias("total_episodes"), F.sum(length).alias("total_frames"), F.count_distinct(F.floor(F.col(key) / 1000)).alias("total_chunks"), F.min(key).alias("first_episode"), F.max(key).alias("last_episode"))


def next_index(episodes: DataFrame, key: str = "episode_index") -> DataFrame:
    return episodes.agg(F.coalesce(F.max(key) + 1, F.lit(0)).alias("next_index"))


def first_of_each(table: DataFrame, value: str, order: str) -> DataFrame:
    """value, order: each distinct value once, where it comes first."""
    return table.groupBy(value).agg(F.min(order).alias(order))


def manifest_of(manifest: DataFrame, episodes: DataFrame, key: str = "episode_index") -> DataFrame:
    """The manifest's rows of these episodes; a row's episode is its output index, else its smoothed one, else its own."""
    names = [c for c in ("output_episode_index", "smooth_episode_index", "episode_index") if c in manifest.columns]
    wanted = episodes.select(F.col(key).cast("bigint").alias("__episode")).distinct()
    return manifest.join(wanted, F.coalesce(*[F.col(c).cast("bigint") for c in names]) == F.col("__episode"), "left_semi")


def by_position(rows: DataFrame, metadata: DataFrame, order: str, key: str = "episode_index") -> DataFrame:
    """rows with the metadata at the place (in the order of `order`, which numbers the rows from 0) that their key names."""
    return rows.join(metadata, F.col(key) == F.col(order), "left")
