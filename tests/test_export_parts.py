"""Cameras of an export, numbers of mixed lists, and copies of datasets."""

import os

import pytest
from pyspark.sql import functions as F

from motionloom.functions import text as X
from motionloom.operators import cameras
from motionloom.sources import copies


def test_cameras():
    got = cameras.resolve([" head ", "", "wrist_d405_rgb", "side"], main_alias="ego_view")
    assert [(c.name, c.alias, c.feature) for c in got] == [("head", "ego_view", "observation.images.ego_view"), ("wrist_d405_rgb", "wrist_view", "observation.images.wrist_view"), ("side", "side", "observation.images.side")]
    assert cameras.resolve(["a", "b"], aliases=["x", " y "], main="b", main_feature="f")[1] == cameras.Camera("b", "y", "f")
    assert cameras.resolve(["a"], main_alias=" ")[0].alias == "a"
    for bad in ({"cameras": [" "]}, {"cameras": ["a", "a "]}, {"cameras": ["a", "b"], "aliases": ["x"]}, {"cameras": ["a", "b"], "aliases": ["x", " "]}, {"cameras": ["a", "b"], "aliases": ["x", "x"]}, {"cameras": ["a", "b"], "features": ["f", "f"]}, {"cameras": ["a", "wrist_view", "wrist_d405_rgb"]}):
        with pytest.raises(ValueError):
            cameras.resolve(**bad)


def test_steps_need_a_frame_of_every_camera(spark):
    ordinals = spark.createDataFrame([(0, "a", "p", 5, 0), (0, "a", "p", 9, 1), (0, "b", "q", 5, 0)], "e int, camera_name string, path string, i int, ordinal bigint")
    steps = spark.createDataFrame([(0, 0, "a", "p", 9), (0, 0, "b", "q", 5), (0, 1, "a", "p", 7), (0, 1, "b", "q", 5), (1, 0, "a", "p", 5), (0, 2, "a", None, 5)], "e int, step int, camera_name string, path string, i int")
    got = cameras.with_ordinals(steps, ordinals, "camera_name", "path", "i", ["e"])
    assert {(r.e, r.step, r.camera_name): (r.ordinal, r.video_reason) for r in got.collect()} == {(0, 0, "a"): (1, None), (0, 0, "b"): (0, None), (0, 1, "a"): (None, "missing_video"), (0, 1, "b"): (0, None), (1, 0, "a"): (None, "missing_video"), (0, 2, "a"): (None, "missing_video")}
    assert [tuple(r) for r in cameras.whole_steps(got, ["e", "step"], ["a", "b"]).collect()] == [(0, 0)]
    shapes = spark.createDataFrame([(0, 0, 4, 6), (0, 1, 4, 6), (1, 0, 4, 6), (1, 1, 6, 4), (2, 0, None, 6)], "e int, step int, height int, width int")
    assert [tuple(r) for r in cameras.shape_breaks(shapes, "e", "step").collect()] == [(1, "inconsistent_video_shape")]


def test_numeric_items(spark):
    rows = ['[1, 2.5, "3", true, null, [4], {"a": 5}, 1e300, false]', "[]", '{"a": 1}', "7", "null", None]
    got = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string").select("i", X.numeric_items(F.parse_json("t")).alias("v")).collect()
    assert {r.i: r.v for r in got} == {0: [1.0, 2.5, 1.0, 1e300, 0.0], 1: [], 2: [], 3: [], 4: [], 5: []}


@pytest.fixture
def dataset(tmp_path):
    for name, text in {"meta/info.json": "{}", "meta/info.json.bak_1": "old", "data/a.parquet": "x" * 1000, "data/deep/b.bin": "", "data/c.tmp": "torn"}.items():
        p = tmp_path / "set" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)
    return tmp_path


def test_copies_and_restarts(spark, dataset):
    source, target = str(dataset / "set"), str(dataset / "to" / "copy")
    assert copies.copy_dataset(spark, source, target) == {"copied": 3, "kept": 0, "bytes": 1002}
    found = sorted(os.path.relpath(os.path.join(d, f), target) for d, _, fs in os.walk(target) for f in fs if not f.endswith(".crc"))
    assert found == ["data/a.parquet", "data/deep/b.bin", "meta/info.json"]
    with pytest.raises(FileExistsError):
        copies.copy_dataset(spark, source, target)
    os.remove(f"{target}/data/a.parquet")
    open(f"{target}.unfinished", "w").close()
    assert copies.copy_dataset(spark, source, target) == {"copied": 1, "kept": 2, "bytes": 1000}
    assert not os.path.exists(f"{target}.unfinished")
    open(f"{target}/stale", "w").close()
    assert copies.copy_dataset(spark, source, target, overwrite=True)["copied"] == 3 and not os.path.exists(f"{target}/stale")
    with pytest.raises(ValueError):
        copies.copy_dataset(spark, source, source + "/inside")
    with pytest.raises(FileNotFoundError):
        copies.copy_dataset(spark, source + "x", target + "y")


def test_arranged_by_date(spark, dataset):
    made = copies.created_at(spark, str(dataset / "set"))
    assert abs(made.timestamp() - os.stat(dataset / "set").st_ctime) < 1 and made.utcoffset() is not None
    rows = copies.arrange(spark, [str(dataset / "set"), str(dataset / "absent")], "raw", str(dataset / "by"), "copy").collect()
    assert [(r.item_type, r.name, r.date, r.mode) for r in rows] == [("raw", "set", made.strftime("%Y-%m-%d"), "copy")]
    assert os.path.isfile(f"{rows[0].link_path}/meta/info.json") and rows[0].created_at == made.isoformat()
    assert copies.arrange(spark, [str(dataset / "set")], "raw", str(dataset / "by2")).first().mode == "reference" and not os.path.exists(dataset / "by2")
    with pytest.raises(ValueError):
        copies.arrange(spark, [str(dataset / "set")] * 2, "raw", str(dataset / "by2"))
