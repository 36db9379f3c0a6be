"""A stream that fails at any step and starts again appends every row once."""

import pytest

from motionloom.streaming import append as A

SCHEMA = "id bigint, x string"


def read(spark, target):
    return sorted((r.id, r.x) for r in A.read_appended(spark, target, SCHEMA).collect())


@pytest.mark.parametrize("at", ["data", "log"])
def test_restart(spark, tmp_path, at):
    source, target, check = (f"file://{tmp_path}/{n}" for n in ("in", "out", "check"))
    spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA).write.parquet(source)
    stream = lambda: spark.readStream.schema(SCHEMA).parquet(source)
    assert read(spark, target) == []
    A.append_stream(stream(), target, check).awaitTermination()
    assert read(spark, target) == [(1, "a"), (2, "b")]
    spark.createDataFrame([(3, "c"), (4, None)], SCHEMA).write.mode("append").parquet(source)

    def step(name):
        if name == at:
            raise RuntimeError("lost")

    with pytest.raises(Exception):
        A.append_stream(stream(), target, check, step).awaitTermination()
    assert read(spark, target) == [(1, "a"), (2, "b")]
    for _ in range(2):
        A.append_stream(stream(), target, check).awaitTermination()
        assert read(spark, target) == [(1, "a"), (2, "b"), (3, "c"), (4, None)]


def test_a_logged_batch_is_left_alone(spark, tmp_path):
    target = f"file://{tmp_path}/t"
    A.append_batch(spark.createDataFrame([(1, "a")], SCHEMA), 0, target)
    A.append_batch(spark.createDataFrame([(9, "z")], SCHEMA), 0, target)
    assert read(spark, target) == [(1, "a")]
