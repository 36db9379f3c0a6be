"""Components of embeddings against a plain decomposition, and motion between frames against known shifts."""

import json

import numpy as np
import pytest

from motionloom.operators import embeddings, flow


def test_components_equal_plain_decomposition(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 9)) @ np.diag([5, 3, 1, 1, 1, 0.5, 0.5, 0.2, 0.1]) + 4
    rows = [(i, json.dumps(v.tolist()), None, "[1.0]" if i < 2 else None) for i, v in enumerate(x)]
    rows += [(100, "[1.0, 2.0]", None, ""), (101, "no list", None, None), (102, None, None, None), (103, "[]", None, None), (104, json.dumps([1.0] * 8 + [None]), None, None)]
    e = spark.createDataFrame(rows, "episode_index bigint, video_embedding string, state_action_embedding string, language_embedding string").repartition(5)
    episodes = spark.createDataFrame([(i, f"2026-01-{i % 9 + 1:02d}") for i in range(50)], "episode_index bigint, source_date string")
    got, status = embeddings.reduced(e, episodes)
    assert status["state_action"] == "skipped:no_embeddings" and status["language"] == "skipped:not_enough_points"
    assert status["video_pca"] == "ok" and {status["video_tsne"], status["video_umap"]} <= {"available", "skipped:sklearn_not_installed", "skipped:umap_not_installed"}
    found = {r.episode_index: r for r in got.collect()}
    assert set(found) == set(range(60))
    assert found[3].source_date == "2026-01-04" and found[55].source_date is None
    c = x - x.mean(0)
    plain = c @ np.linalg.svd(c, full_matrices=False)[2][:2].T
    ours = np.array([[found[i].x, found[i].y] for i in range(60)])
    for k in range(2):
        assert min(np.abs(ours[:, k] - plain[:, k]).max(), np.abs(ours[:, k] + plain[:, k]).max()) < 1e-8


def test_first_row_fixes_the_width(spark):
    e = spark.createDataFrame([(2, "[1, 2, 3]"), (1, "[4, 5]"), (0, "x"), (3, "[6, 7]")], "episode_index bigint, video_embedding string").repartition(3)
    assert {r.episode_index: list(r.v) for r in embeddings.vectors(e, "video_embedding").collect()} == {1: [4.0, 5.0], 3: [6.0, 7.0]}
    assert embeddings.reduced(e.where("episode_index > 5"), e.selectExpr("episode_index", "'d' AS source_date"))[0] is None


def picture(dx=0.0, dy=0.0, h=120, w=160):
    y, x = np.mgrid[:h, :w].astype(float)
    x, y = x - dx, y - dy
    return 120 + 40 * np.sin(x / 7) * np.cos(y / 9) + 30 * np.sin((x + 2 * y) / 15) + 20 * np.cos((2 * x - y) / 11)


@pytest.mark.parametrize("dx, dy", [(0.0, 0.0), (1.0, 0.0), (0.0, -2.0), (3.0, 2.0), (-4.5, 1.5)])
def test_known_shifts(dx, dy):
    d = flow.flow(picture(), picture(dx, dy))
    inner = d[:, 20:-20, 20:-20]
    assert np.abs(inner - np.array([dx, dy])[:, None, None]).mean() < 0.15


def test_area_means():
    g = np.arange(48.0).reshape(6, 8)
    assert np.allclose(flow.resized(g, 3, 4), g.reshape(3, 2, 4, 2).mean(axis=(1, 3)))
    assert flow.resized(g, 4, 3).mean() == pytest.approx(g.mean())


def test_flow_of_frames(spark):
    wide = lambda dx: [float(v) for v in picture(dx).ravel()]
    rows = [(0, 0, wide(0), 160), (0, 1, wide(2), 160), (0, 2, None, 160), (0, 3, wide(0), 160), (1, 0, wide(0), 160), (1, 1, [1.0, 2.0, 3.0], 160)]
    f = spark.createDataFrame(rows, "video int, frame int, gray array<double>, width int").repartition(3)
    got = {(r.video, r.frame): r for r in flow.optical_flow(f, ["video"], "frame").collect()}
    assert {k: r.flow_status for k, r in got.items()} == {(0, 0): "first_frame", (0, 1): "ok", (0, 2): "unavailable", (0, 3): "unavailable", (1, 0): "first_frame", (1, 1): "unavailable"}
    assert got[0, 1].optical_flow_magnitude == pytest.approx(2, abs=0.3) and got[0, 0].optical_flow_magnitude is None
