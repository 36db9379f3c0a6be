"""Appending clips: numbers, refusals, and crashes between any two steps."""

import pytest
from pyspark.sql import functions as F

from motionloom.operators import clips as C
from motionloom.sources import datasets


@pytest.fixture
def stored(spark, tmp_path):
    for name, episodes in (("source", 3), ("target", 2)):
        frames = spark.range(episodes * 8).select((F.col("id") / 8).cast("bigint").alias("episode_index"), (F.col("id") % 8).alias("frame_index"), F.array(F.col("id") * 1.0).alias("state"), (F.col("id") * 0.1).alias("timestamp"), F.lit(False).alias("done"))
        lengths = datasets.write_frames(frames, root := f"file://{tmp_path}/{name}")
        eps = lengths.select("episode_index", F.array(F.lit("pick")).alias("tasks"), "length")
        datasets.write_metadata(spark, root, eps, spark.createDataFrame([(0, "pick")], "task_index bigint, task string"), 10.0, {}, {})
    return f"file://{tmp_path}/source", f"file://{tmp_path}/target"


def content(spark, root):
    return sorted((r.episode_index, r.frame_index, r["index"], r.state[0], round(r.timestamp, 6), r.done) for r in C.read_listed(spark, root).collect())


def clips(spark, *rows):
    return spark.createDataFrame(rows, "source_episode bigint, start_frame bigint, end_frame bigint")


def test_append(spark, stored):
    source, target = stored
    before = content(spark, target)
    new = C.append_clips(spark, source, target, clips(spark, (2, 1, 3), (0, 0, 7), (2, 2, 2)), 10.0, "t").collect()
    assert sorted((r.episode_index, r.length, r.clip.source_episode, r.clip.start_frame) for r in new) == [(2, 8, 0, 0), (3, 3, 2, 1), (4, 1, 2, 2)]
    after = content(spark, target)
    assert after[:16] == before and [r[2] for r in after] == list(range(28))
    assert after[24:] == [(3, 0, 24, 17.0, 0.0, False), (3, 1, 25, 18.0, 0.1, False), (3, 2, 26, 19.0, 0.2, True), (4, 0, 27, 18.0, 0.0, True)]
    C.append_clips(spark, source, target, clips(spark, (1, 0, 0)), 10.0, "t")
    assert content(spark, target)[:28] == after and content(spark, target)[28][:4] == (5, 0, 28, 8.0)


@pytest.mark.parametrize("at", ["frames", "chunk", "episodes"])
def test_crash_leaves_the_dataset_as_it_was(spark, stored, at):
    source, target = stored
    before = content(spark, target)

    def step(name):
        if name == at:
            raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        C.append_clips(spark, source, target, clips(spark, (1, 2, 5)), 10.0, "t", step=step)
    assert content(spark, target) == before
    C.append_clips(spark, source, target, clips(spark, (1, 2, 4)), 10.0, "t")
    after = content(spark, target)
    assert after[:16] == before and [r[:4] for r in after[16:]] == [(2, 0, 16, 10.0), (2, 1, 17, 11.0), (2, 2, 18, 12.0)]
    assert spark.read.parquet(f"{target}/data").count() == 19  # nothing of the first try is left


def test_refusals_come_before_the_first_byte(spark, stored):
    source, target = stored
    before = content(spark, target)
    layout = {"state": {"arm": [0, 1]}, "tasks": ["pick"]}
    for source_, rows, layouts, why in ((target, (0, 0, 1), None, "same dataset"), (source, (0, 3, 2), None, "no frames"), (source, (0, 0, 8), None, "beyond"), (source, (9, 0, 1), None, "beyond"), (source, (0, 0, 1), (layout, layout | {"tasks": ["place"]}), "tasks differ"), (source, (0, 0, 1), (layout, {"state": {"arm": [0, 2]}, "tasks": ["pick"]}), "state layout")):
        with pytest.raises(ValueError, match=why):
            C.append_clips(spark, source_, target, clips(spark, rows), 10.0, "t", layouts, step=lambda _: pytest.fail("wrote"))
    assert content(spark, target) == before
    assert C.compatible({"state": {"arm": 1, "hand": 2}}, {"state": {"arm": 1}}) == []
    other = C.read_listed(spark, source).withColumn("extra", F.lit(1))
    datasets.write_frames(other.drop("index", "chunk"), root := f"{source}2")
    with pytest.raises(ValueError, match="columns"):
        C.append_clips(spark, root, target, clips(spark, (0, 0, 1)), 10.0, "t")
