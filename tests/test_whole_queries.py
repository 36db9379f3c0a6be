"""Queries that go as far as the reference does, on small tables made here."""

import numpy as np
import pandas as pd
import pytest
from oracle import connect, same

from motionloom.plans import kinematics, registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Two episodes of 40 frames, whose action runs 12 frames ahead of the state; users with 1 to 9 events."""
    at, rng, rows = tmp_path_factory.mktemp("whole"), np.random.default_rng(2), []
    for label in range(2):
        x = rng.normal(size=(52, 64)).cumsum(axis=0)
        x[12:, 7:10] = x[:40, 26:29]
        rows += [(100 * label + t, v.astype("float32").tolist(), label) for t, v in enumerate(x[12:])]
    pd.DataFrame(rows, columns=["vec_id", "embedding", "label"]).to_parquet(at / "embeddings.parquet")
    events = [(u, t) for u in range(1, 10) for t in range(u)]
    pd.DataFrame({"event_id": range(len(events)), "ts": pd.to_datetime([f"2024-01-01 00:00:{t:02d}" for _, t in events]).astype("datetime64[us]"), "user_id": [u for u, _ in events], "event_type": "a", "value": rng.normal(size=len(events)), "props": "{}"}).to_parquet(at / "events.parquet")
    return str(at)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.endswith("_all_horizons")))
def test_all_horizons(spark, folder, name):
    got = QUERIES[name](spark, folder).toPandas()
    same(got, connect(folder).sql(SQL[name]).df())
    if "horizon" in got:
        assert set(got.horizon) == {1, 2, 4, 8, 16, 32} == set(kinematics.HORIZONS)


def test_lag_of_twelve_frames(spark, folder):
    got = QUERIES["lag_by_rmse_20"](spark, folder).toPandas()
    same(got, connect(folder).sql(SQL["lag_by_rmse_20"]).df())
    assert set(got.lag) == {12} and got.rmse.max() < 1e-5


def test_savgol_keeps_short_episodes(spark, folder):
    got = QUERIES["savgol_smooth_every_episode"](spark, folder).toPandas()
    same(got, connect(folder).sql(SQL["savgol_smooth_every_episode"]).df())
    assert len(got) == 45 and len(QUERIES["savgol_smooth"](spark, folder).toPandas()) == 24
