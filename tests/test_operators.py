"""Operators on hand-made frames, with known answers or plain NumPy beside them."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from motionloom import plugins, schema
from motionloom.functions import payloads
from motionloom.functions import text as X
from motionloom.functions import vectors as V
from motionloom.operators import asof, exports, incremental, mapping, rules, sequences, smoothing, stats, video
from motionloom.sources import datasets, logs
from motionloom.streaming import incremental as live


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def arr(*xs):
    return F.array(*[F.lit(float(x)) for x in xs])


def test_dates_and_names(spark):
    c = [F.lit("none"), F.lit("episode_20260624T090839Z_000000")]
    assert one(spark, X.source_date(c)) == "2026-06-24"
    assert one(spark, X.source_date([F.lit("x/2026-01-02/y")])) == "2026-01-02"
    assert one(spark, X.source_date([F.lit(None).cast("string")])) == "unknown"
    assert one(spark, X.frame_rate(F.lit("30000/1001"))) == pytest.approx(29.97003)
    assert one(spark, X.frame_rate(F.lit("1/0"))) is None and one(spark, X.frame_rate(F.lit("x"))) is None
    assert one(spark, X.path_component(F.lit("a/b c--d/"))) == "b_c--d"
    assert one(spark, X.path_component(F.lit("..."))) == "unnamed"
    assert one(spark, X.data_path(F.lit(1234).cast("bigint"))) == "data/chunk-001/episode_001234.parquet"
    assert one(spark, X.task_text(F.lit(" "), F.lit(None).cast("string"))) == "teleop"
    assert one(spark, X.last_dotted(F.lit("a.b.r00"))) == "r00"
    assert one(spark, X.camera_matches(F.lit("b"), "a", {"a": "b"})) is True


def test_fingerprint_depends_on_signature(spark):
    f = lambda v: one(spark, X.fingerprint(version=F.lit(v), name=F.lit("a")))
    assert f(1) == f(1) != f(2)


def test_rotations(spark):
    h = math.sqrt(0.5)
    assert one(spark, V.quaternion_to_rot6d(arr(h, 0, 0, h))) == pytest.approx([1, 0, 0, 0, 0, -1], abs=1e-12)
    assert one(spark, V.action_quaternion_to_rot6d(arr(0, 0, 0, 1))) == pytest.approx([1, 0, 0, 0, -1, 0], abs=1e-12)
    assert one(spark, V.xyz_to_state_frame(arr(1, 2, 3))) == [3, 1, 2]
    assert one(spark, V.quaternion_to_rot6d(arr(0, 0, 0, 0))) is None
    rows = one(spark, V.rot6d_rows(arr(2, 0, 0, 1, 3, 0)))
    assert np.allclose(rows, np.eye(3))
    assert one(spark, V.rotation_between(V.rot6d_rows(arr(1, 0, 0, 0, 1, 0)), V.rot6d_rows(arr(0, 1, 0, -1, 0, 0)))) == pytest.approx(90)
    assert one(spark, V.rotation_between(F.lit(None).cast("array<array<double>>"), V.rot6d_rows(arr(1, 0, 0, 0, 1, 0)))) is None
    assert one(spark, V.finite(F.lit(float("nan")))) is None


def test_named_values(spark):
    got = lambda names, values: one(spark, X.named_values(F.array(*map(F.lit, names)), F.array(*[F.lit(v).cast("double") for v in values]), ["a", "b"]))
    assert got(["b", "a", "a"], [1.0, 2.0, 3.0]) == [3.0, 1.0]
    assert got(["b"], [1.0]) is None and got(["a", "b"], [1.0, None]) is None


def test_payload_vectors(spark):
    ee = "named_struct('position_xyz', array(1D, 2D, 3D), 'quaternion_xyzw', array(0D, 0D, 0D, 1D))"
    robot = F.expr(f"named_struct('arm_joint_positions', array_repeat(0D, 7), 'hand_joint_positions', array_repeat(0D, 10), 'arm_ee_pose', {ee})")
    assert len(one(spark, payloads.state_vector(robot))) == 26
    short = F.expr(f"named_struct('arm_joint_positions', array_repeat(0D, 6), 'hand_joint_positions', array_repeat(0D, 10), 'arm_ee_pose', {ee})")
    assert one(spark, payloads.state_vector(short)) is None and len(one(spark, payloads.plain_state_vector(short))) == 23
    names = [f"j{i}" for i in range(10)]
    action = F.expr(f"named_struct('ee_target', {ee}, 'hand_target', named_struct('joint_names', array({', '.join(map(repr, names))}), 'joint_positions', array_repeat(5D, 10)), 'gripper', named_struct('normalized_position', 1D))")
    got = one(spark, payloads.action_vector(action, names))
    assert got[:9] == [3, 1, 2, 1, 0, 0, 0, -1, 0] and got[9:] == [5.0] * 10


def series(spark, data):
    return spark.createDataFrame([(e, t, float(x)) for e, xs in data.items() for t, x in enumerate(xs)], "episode_index bigint, frame_index bigint, x double")


def test_lag_of_a_delayed_state(spark):
    a = np.cumsum(np.sin(np.arange(120)))
    rows = [(0, t, float(abs(a[t])), float(abs(a[t - 3])) if t >= 3 else None) for t in range(120)]
    got = sequences.lag_by_correlation(spark.createDataFrame(rows, "episode_index bigint, frame_index bigint, a double, s double"), F.col("a"), F.col("s")).first()
    assert got["lag"] == 3 and got["corr"] > 0.9


def test_runs_tail_trim_downsample(spark):
    s = series(spark, {0: [1, 1, 0, 1, 1, 1, 0], 1: [0, 0]})
    assert {r[0]: r[1] for r in sequences.longest_run(s, F.col("x") > 0).collect()} == {0: 3, 1: 0}
    assert sorted(r.frame_index for r in sequences.tail(s).where("episode_index = 0").collect()) == [5, 6]
    t = sequences.trim(s.where("episode_index = 0"), 2, 4, 10).orderBy("frame_index").collect()
    assert [(r.frame_index, r.timestamp, r.done, r.x) for r in t] == [(0, 0.0, False, 0.0), (1, 0.1, False, 1.0), (2, 0.2, True, 1.0)]
    assert sorted(r.frame_index for r in sequences.downsample(s.where("episode_index = 0"), 3).collect()) == [0, 3, 6]


def test_contiguity_in_stored_order(spark):
    s = spark.createDataFrame([(0, 0, 10), (0, 1, 11), (1, 1, 10), (1, 0, 11), (2, None, 1), (3, 0, 1), (3, 0, 2)], "e int, i int, at int")
    assert {r.e: r.contiguous for r in sequences.contiguity(s, "e", "i", "at").collect()} == {0: True, 1: False, 2: False, 3: False}


def test_vector_fingerprint(spark):
    import hashlib

    h = lambda x: hashlib.sha256(x.encode()).hexdigest()
    nan = float("nan")
    s = spark.createDataFrame([(0, 1, [3.0, nan]), (0, 0, [1.0, 2.0]), (0, 2, None), (1, 0, [1.0, 2.0])], "episode_index int, frame_index int, v array<double>")
    frames = [h("1000000,2000000"), h("3000000,null"), h("")]
    got = {r.episode_index: (r.frames, r.fingerprint) for r in sequences.vector_fingerprint(s, "v", chunk=2).collect()}
    assert got == {0: (3, h(h(",".join(frames[:2])) + "," + h(frames[2]))), 1: (1, h(h(frames[0])))}
    assert sequences.vector_fingerprint(s.limit(0), "v").count() == 0


def test_ahead_of_state(spark):
    from motionloom.operators import relative

    s = spark.createDataFrame([(0, k, float(k), 10.0 + k) for k in range(3)] + [(1, 0, 5.0, 6.0)], "episode_index int, frame_index int, own double, sent double")
    got = sorted((r.episode_index, r.frame_index, r.horizon, r.now, r.then) for r in relative.ahead_of_state(s, "own", "sent", (1, 2)).collect())
    assert got == [(0, 0, 1, 0.0, 10.0), (0, 0, 2, 0.0, 11.0), (0, 1, 1, 1.0, 11.0), (0, 1, 2, 1.0, 12.0), (0, 2, 1, 2.0, 12.0), (1, 0, 1, 5.0, 6.0)]


def test_numbers_of_records(spark, tmp_path):
    """The place of a line in its file, also where a file is read by several tasks."""
    from motionloom.schema import LOGS

    field = LOGS["actions"].split(",")[0].split()[0]
    for e in ("a", "b"):
        (tmp_path / "episodes" / e).mkdir(parents=True)
        (tmp_path / "episodes" / e / "actions.jsonl").write_text("".join(f'{{"{field}": null, "x": {k}}}\n' for k in range(50)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    try:
        rows = logs.read_capture(spark, str(tmp_path), "actions").select("episode_dir", "record_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.episode_dir, r.record_no) for r in rows) == [(e, k) for e in "ab" for k in range(50)]


def test_contiguity_and_done(spark):
    s = spark.createDataFrame([(0, 0, False), (0, 1, True), (1, 0, True), (1, 2, True)], "e bigint, i bigint, done boolean")
    assert {r.e: r.contiguous for r in sequences.contiguity(s, "e", "i").collect()} == {0: True, 1: False}
    assert {r.e: r.done_ok for r in sequences.done_only_last(s, "e", "i", F.col("done")).collect()} == {0: True, 1: False}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 7, 20])
def test_savgol_keeps_parabolas(spark, n):
    x = [1.0 + 2 * t - 0.3 * t * t for t in range(n)]
    got = [r.y for r in sequences.savgol(series(spark, {0: x}), "x", "y").orderBy("frame_index").collect()]
    assert got == pytest.approx(x) and smoothing.savgol(np.array(x), 7) == pytest.approx(x)


def test_savgol_column_equals_numpy(spark):
    rng = np.random.default_rng(1)
    data = {e: rng.normal(size=n).tolist() for e, n in enumerate((4, 5, 6, 7, 8, 30))}
    got = sequences.savgol(series(spark, data), "x", "y").orderBy("episode_index", "frame_index").collect()
    for e, x in data.items():
        w = min(7, len(x) - (len(x) % 2 == 0))
        assert [r.y for r in got if r.episode_index == e] == pytest.approx(smoothing.savgol(np.array(x), w) if w >= 5 else x)


def test_savgol_weights():
    assert np.array(sequences.savgol_rows(7))[3] * 21 == pytest.approx([-2, 3, 6, 7, 6, 3, -2])
    assert np.array(sequences.savgol_rows(7))[0] == pytest.approx([16 / 21, 5 / 14, 1 / 14, -2 / 21, -1 / 7, -1 / 14, 5 / 42])


def test_hampel_goes_left_to_right():
    x = np.array([0, 0.1, 0, 9, 9, 0, 0.1, 0, 0.1, 0])
    y, n = smoothing.hampel(x, 7, 3.0)
    assert n == 2 and y.max() < 1
    assert smoothing.hampel(np.zeros(5), 7, 3.0)[1] == 0


def test_rotation_logarithm():
    v = np.random.default_rng(0).normal(size=(20, 3))
    v = v / np.linalg.norm(v, axis=1, keepdims=True) * np.linspace(0, 3.1, 20)[:, None]
    assert np.allclose(smoothing.log_rotation(smoothing.exp_rotation(v)), v, atol=1e-6)


def test_smooth_episodes_keeps_constant_motion(spark):
    rows = [(0, t, [float(t)] * 3 + [1.0, 0.0, 0.0, 0.0, 1.0, 0.0]) for t in range(12)]
    df = spark.createDataFrame(rows, "episode_index bigint, frame_index bigint, action array<double>")
    out = smoothing.smooth_episodes(df, {"action": {"xyz": (0, 3), "rot6d": (3, 9)}}).orderBy("frame_index").collect()
    assert all(np.allclose(r.action, rows[i][2], atol=1e-9) for i, r in enumerate(out))


def test_asof_ties_future_and_fallback(spark):
    rec = spark.createDataFrame([(0, 1.0, 5), (0, 3.0, 6), (0, 3.0, 4), (1, None, 9)], "k bigint, ts double, no bigint")
    tgt = spark.createDataFrame([(0, 2.0, 0), (0, 3.0, 1), (0, 9.0, 2), (0, 3.0000000005, 3), (1, 1.0, 4)], "k bigint, ts double, id bigint")
    near = {r.id: (r.m_no, r.m_dt) for r in asof.asof(tgt, rec, "k", "ts", "no").collect()}
    assert near[0] == (4, 1.0) and near[1] == (4, 0.0) and near[2] == (4, -6.0) and near[4] == (None, None)
    ahead = {r.id: r.m_no for r in asof.asof(tgt, rec, "k", "ts", "no", "future").collect()}
    assert ahead[0] == 4 and ahead[2] == 4 and ahead[3] == 4


def test_camera_sync(spark):
    a = spark.createDataFrame([(0, 1.00, 0)], "k bigint, ts double, no bigint")
    b = spark.createDataFrame([(0, 1.02, 7)], "k bigint, ts double, no bigint")
    r = asof.camera_sync(a, {"wrist": b}, "k", "ts", "no").first()
    assert r.mean_ts == pytest.approx(1.01) and r.wrist_no == 7
    assert asof.camera_sync(a, {"wrist": b.where("k = 5")}, "k", "ts", "no").count() == 0


def test_export_from_logs(spark, tmp_path):
    names = [f"j{i}" for i in range(10)]
    ee = {"position_xyz": [1.0, 2.0, 3.0], "quaternion_xyzw": [0.0, 0.0, 0.0, 1.0]}
    d = tmp_path / "episodes" / "e0"
    d.mkdir(parents=True)
    lines = lambda rows: "\n".join(json.dumps(r) for r in rows) + "\n\n"
    (d / "actions.jsonl").write_text(lines([{"monotonic_ts_s": t / 10, "safe_action": {"ee_target": ee, "hand_target": {"joint_names": names, "joint_positions": [0.5] * 10}}} for t in range(11)]))
    (d / "robot.jsonl").write_text(lines([{"monotonic_ts_s": t / 10 + 0.01, "arm_joint_positions": [0.0] * 7, "hand_joint_positions": [0.0] * 10, "arm_ee_pose": ee} for t in range(11) if t != 5]))
    (d / "video.jsonl").write_text(lines([{"monotonic_ts_s": t / 10, "camera_name": "c", "relative_path": "v", "frame_index": t} for t in range(9)]))
    root = str(tmp_path)
    streams = {n: logs.episode_numbers(logs.read_capture(spark, root, n)) for n in ("actions", "robot", "video")}
    how = exports.Export(tolerance_s=0.095, hand_names=tuple(names))
    steps = exports.export_steps(streams["actions"], streams["robot"], streams["video"], how).orderBy("step").collect()
    assert len(steps) == 8 and sum(r.reason is None for r in steps) == 7
    assert {r.reason for r in steps} == {None, "robot_out_of_tolerance"}
    frames = exports.frames_of(exports.export_steps(streams["actions"], streams["robot"], streams["video"], how), 10).orderBy("frame_index").collect()
    assert [f.frame_index for f in frames] == list(range(7)) and [f.done for f in frames] == [False] * 6 + [True] and len(frames[0].state) == 26 and len(frames[0].action) == 19
    eps = spark.createDataFrame([(0, True), (1, None)], "episode_index bigint, success boolean")
    allsteps = exports.export_steps(streams["actions"], streams["robot"], streams["video"], how)
    assert {r.episode_index: r.reason for r in exports.skipped(eps, allsteps, how).collect()} == {1: "empty_stream_time_intersection"}
    assert logs.read_capture(spark, root, "frames").count() == 0


def test_outliers(spark):
    vals = [1.0, 1.1, 0.9, 1.0, 1.05, 0.95, 1.0, 1.02, 9.0]
    s = series(spark, {i: [v] for i, v in enumerate(vals)})
    assert [r.episode_index for r in stats.robust_mask(s, "x").where("outlier").collect()] == [8]
    assert stats.robust_mask(s.where("episode_index < 7"), "x").where("outlier").count() == 0
    flat = series(spark, {i: [v] for i, v in enumerate([1.0] * 18 + [5.0, 9.0])})
    assert [r.episode_index for r in stats.robust_mask(flat, "x").where("outlier").collect()] == [19]
    top = stats.robust_scores(s.withColumn("y", F.lit(1.0)), ["y", "x"]).where("episode_index = 8").first()
    assert top.top_metric == "x" and top.outlier_score > 3.5


def test_summaries_skip_what_is_not_finite(spark):
    s = series(spark, {0: [1.0, float("nan"), 3.0, float("inf")], 1: [float("nan")]})
    r = {x.episode_index: x for x in s.groupBy("episode_index").agg(*stats.summary(F.col("x"), "x", ("n", "mean", "std", "p50", "max"))).collect()}
    assert (r[0].x_n, r[0].x_mean, r[0].x_std, r[0].x_p50, r[0].x_max) == (2, 2.0, 1.0, 2.0, 3.0)
    assert r[1].x_mean is None


def test_correlation_needs_spread(spark):
    s = spark.createDataFrame([(0, 1.0, 1.0), (0, 2.0, 1.0), (0, 3.0, 1.0), (1, 1.0, 2.0), (1, 2.0, 4.0)], "e bigint, a double, b double")
    assert all(r.c is None for r in s.groupBy("e").agg(stats.guarded_corr(F.col("a"), F.col("b")).alias("c")).collect())


def test_pca_finds_the_line(spark):
    s = spark.createDataFrame([(i, float(i), 2.0 * i) for i in range(10)], "k bigint, a double, b double")
    got = stats.pca2(s, "k", ["a", "b"]).collect()
    assert max(abs(r.pc2) for r in got) < 1e-9 and got[9].pc1 > got[0].pc1


def test_axis_permutation_is_found(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=(40, 3))
    p, s = (2, 0, 1), (1, -1, 1)
    st = np.stack([s[i] * a[:, p[i]] for i in range(3)], axis=1) + 0.5
    df = spark.createDataFrame([(0, x.tolist(), y.tolist()) for x, y in zip(st, a, strict=True)], "episode_index bigint, s array<double>, a array<double>")
    r = mapping.best_axis_permutation(df, "s", "a").first()
    assert (r.perm, r.signs) == ("201", "+-+") and r.rmse < 1e-6


@pytest.mark.parametrize("transpose", [False, True])
def test_rotation_map_is_found(spark, transpose):
    axes = mapping.signed_axis_matrices()
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.normal(size=(15, 3, 3)))[0]
    q *= np.sign(np.linalg.det(q))[:, None, None]
    left, right = axes[11], axes[29]
    if np.linalg.det(left) * np.linalg.det(right) < 0:
        right = -right
    st = left @ (q.transpose(0, 2, 1) if transpose else q) @ right
    rows = [(0, i, s[:2].ravel().tolist(), a[:2].ravel().tolist()) for i, (s, a) in enumerate(zip(st, q, strict=True))]
    r = mapping.best_rotation_map(spark.createDataFrame(rows, "episode_index bigint, frame_index bigint, s array<double>, a array<double>"), "s", "a").first()
    made = axes[r.left] @ (q.transpose(0, 2, 1) if r.transpose else q) @ axes[r.right]
    assert r.degrees < 1e-3 and np.allclose(made, st)


def test_rotation_map_reads_every_frame(spark):
    """450 frames: 250 follow one map, but every frame that an even sample of 200 picks follows another."""
    axes, n = mapping.signed_axis_matrices(), 450
    q = np.linalg.qr(np.random.default_rng(6).normal(size=(n, 3, 3)))[0]
    q *= np.sign(np.linalg.det(q))[:, None, None]
    sampled = np.unique(np.linspace(0, n - 1, 200).astype(int))
    proper = [m for m in axes if np.linalg.det(m) > 0]
    st = proper[3] @ q
    st[sampled] = proper[5] @ q[sampled]
    rows = [(0, i, s[:2].ravel().tolist(), a[:2].ravel().tolist()) for i, (s, a) in enumerate(zip(st, q, strict=True))]
    df = spark.createDataFrame(rows, "episode_index bigint, frame_index bigint, s array<double>, a array<double>")
    means = []
    for flip in (False, True):
        for left in range(48):
            for right in range(48):
                made = axes[left] @ (q.transpose(0, 2, 1) if flip else q) @ axes[right]
                means.append((round(float(np.degrees(np.arccos(np.clip(((st * made).sum(axis=(1, 2)) - 1) / 2, -1, 1))).mean()), 6), flip, left, right))
    for chunk in (2048, 64):
        r = mapping.best_rotation_map(df, "s", "a", chunk=chunk).first()
        assert (round(r.degrees, 6), r.transpose, r.left, r.right) == min(means)
    few = mapping.best_rotation_map(df, "s", "a", most=200).first()
    assert few.degrees < 1e-3 and (few.left, few.right) != min(means)[2:]


def test_one_error_lowers_the_score(spark):
    t = spark.createDataFrame([(0, "d", True), (1, "d", False)], "episode_index bigint, source_date string, frame_count_match boolean")
    found = rules.issues(t, [rules.Rule("state_action_frame_mismatch", "error", ~F.col("frame_count_match"))])
    s = {r.episode_index: r for r in rules.scores(t, found).collect()}
    assert (s[0].quality_score, s[1].quality_score, s[1].error_count, s[1].issue_summary) == (100.0, 65.0, 1, "state_action_frame_mismatch")
    assert [r.episode_index for r in rules.worst(rules.scores(t, found), 1).collect()] == [1]


def test_incremental_second_run_computes_nothing(spark):
    now = spark.createDataFrame([(0, "a"), (1, "b")], "k bigint, f string")
    log = spark.createDataFrame([(0, "old", 1), (0, "a", 2), (1, "b", 3)], "k bigint, f string, line bigint")
    assert incremental.to_do(now, incremental.latest(log, "k", "line"), "k", "f").count() == 0
    assert incremental.to_do(now, log.where("line = 1"), "k", "f").count() == 2
    assert incremental.next_index(now, "k").first()[0] == 2


def test_dataset_round_trip(spark, tmp_path):
    root = str(tmp_path / "ds")
    frames = spark.createDataFrame([(e, t, [1.0], [2.0], t == 2) for e in (0, 1001) for t in range(3)], "episode_index bigint, frame_index bigint, state array<double>, action array<double>, done boolean")
    lengths = datasets.write_frames(frames, root)
    back = datasets.read_frames(spark, root)
    assert sorted(r["index"] for r in back.collect()) == list(range(6)) and "state" in back.columns
    tasks = spark.createDataFrame([(0, "t")], "task_index bigint, task string")
    info = datasets.write_metadata(spark, root, lengths, tasks, 10.0, {}, {"state": {"arm": {"start": 0, "end": 7}}})
    assert (info["total_frames"], info["total_chunks"]) == (6, 2)
    assert logs.read_json(spark, f"{root}/meta/info.json")["total_episodes"] == 2 and logs.find_datasets(spark, str(tmp_path)) == [f"file:{root}"]
    assert schema.slices_from_modality(logs.read_json(spark, f"{root}/meta/modality.json"))["arm_state"] == schema.Slice("state", 0, 7)
    m = spark.createDataFrame([("raw", "a"), ("view", "b")], "item_type string, name string")
    datasets.write_manifest(m, f"{root}/manifest")
    datasets.write_manifest(m.where("item_type = 'raw'").withColumn("name", F.lit("c")), f"{root}/manifest")
    assert {tuple(r) for r in spark.read.parquet(f"{root}/manifest").collect()} == {("raw", "c"), ("view", "b")}
    payload = datasets.report_payload({"n": 1}, worst=m.withColumn("v", F.lit(float("nan"))))
    assert json.loads(payload)["worst"][0].get("v") is None and "<table>" in datasets.html_report("r", payload)


def test_bad_log_line_fails_and_missing_log_is_empty(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": 1}\n\nnot json\n')
    with pytest.raises(Exception):
        logs.read_jsonl(spark, str(tmp_path / "a.jsonl"), "x bigint").collect()
    assert logs.read_jsonl(spark, str(tmp_path / "none.jsonl"), "x bigint").count() == 0


def test_non_finite_paths(spark):
    assert one(spark, logs.non_finite_paths(F.lit('{"a": [1, NaN], "b": {"c": Infinity}}'))) == ["a.1", "b.c"]


def test_video(spark):
    df = spark.createDataFrame([(0, 0, 3, [0.0] * 9), (0, 1, 3, [255.0] * 9)], "k bigint, t bigint, width int, gray array<double>")
    q = {r.t: r for r in video.frame_quality(df).collect()}
    assert (q[0].under, q[1].over, q[1].brightness, q[0].blur) == (1.0, 1.0, 255.0, 0.0)
    assert [r.diff for r in video.consecutive_difference(df, ["k"], "t").orderBy("t").collect()] == [None, 255.0]
    assert [r.visibility for r in video.detector(df, lambda v: {"score": v.mean()}).orderBy("t").collect()] == [0.0, 255.0]


def test_plugins(spark):
    df = spark.createDataFrame([Row(episode_index=0), Row(episode_index=1)])

    def backend(c):
        return {"video_embedding": [1, 2]} if c["episode_index"] == 0 else None

    got = {r.episode_index: (r.status, r.video_embedding) for r in plugins.embed(df, backend).collect()}
    assert got == {0: ("ok", "[1.0, 2.0]"), 1: ("error", None)}
    assert plugins.load("json:dumps") is json.dumps and plugins.reduce_status("umap").startswith("skipped")


def test_files_are_processed_once(spark, tmp_path):
    src, seen = str(tmp_path / "in"), []
    spark.range(3).write.parquet(src)
    handle = lambda df, n: seen.append(df.count())
    live.process_new(spark, src, "id bigint", str(tmp_path / "cp"), handle)
    live.process_new(spark, src, "id bigint", str(tmp_path / "cp"), handle)
    spark.range(2).write.mode("append").parquet(src)
    live.process_new(spark, src, "id bigint", str(tmp_path / "cp"), handle)
    assert [n for n in seen if n] == [3, 2]


def test_windowed_counts(spark, sf, tmp_path):
    e = spark.read.parquet(f"{sf}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    e.write.parquet(src := str(tmp_path / "ev"))
    q = live.windowed_counts(spark.readStream.schema(e.schema).parquet(src)).writeStream.outputMode("complete").format("memory").queryName("wc").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("SELECT sum(events) FROM wc").first()[0] == e.count()


def test_indices_of_names():
    names = ["state.x", "state.y", "state.z", "hand.a"]
    assert schema.indices_of(names, ["x", "y", "z"], contiguous=True) == [0, 1, 2]
    with pytest.raises(ValueError):
        schema.indices_of(names, ["x", "hand.a"], contiguous=True)
    with pytest.raises(KeyError):
        schema.indices_of(names, ["w"])
