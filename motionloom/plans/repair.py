"""Queries on mapping search, sequential smoothing and repair."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionloom.functions.vectors import r6
from motionloom.operators import mapping as M
from motionloom.operators import rotation as RO
from motionloom.operators import smoothing as S
from motionloom.plans.registry import query
from motionloom.plans.views import VF, scalar_frames, vector_frames

E = "episode_index"


def _permutation_sql() -> str:
    rows = ", ".join(f"({n}, [{', '.join(str(i + 1) for i in p)}], [{', '.join(map(str, s))}], '{''.join(map(str, p))}', '{''.join('+' if x > 0 else '-' for x in s)}')" for n, (p, s) in enumerate(M.signed_permutations()))
    return f"""WITH {VF}, c(candidate, p, s, perm, signs) AS (VALUES {rows}), x AS (SELECT episode_index, state[8:10] AS st, action[1:3] AS ac FROM vf),
 d AS (SELECT x.episode_index, c.candidate, any_value(perm) AS perm, any_value(signs) AS signs, sqrt((var_pop(st[1] - s[1] * ac[p[1]]) + var_pop(st[2] - s[2] * ac[p[2]]) + var_pop(st[3] - s[3] * ac[p[3]])) / 3) AS rmse FROM x, c GROUP BY 1, 2),
 k AS (SELECT *, row_number() OVER (PARTITION BY episode_index ORDER BY round(rmse, 9), candidate) AS k FROM d)
 SELECT episode_index, candidate, perm, signs, round(rmse, 6) AS rmse FROM k WHERE k = 1"""


@query("best_axis_permutation", _permutation_sql())
def best_axis_permutation(spark: SparkSession, d: str) -> DataFrame:
    v = vector_frames(spark, d).select(E, F.slice("state", 8, 3).alias("s"), F.slice("action", 1, 3).alias("a"))
    return M.best_axis_permutation(v, "s", "a").withColumn("rmse", r6("rmse"))


def _candidates() -> str:
    """Of each map: its numbers, and for the nine elements of L A R the place in A (by rows, or by columns if A is transposed) and the sign."""
    rows, n = [], 0
    for flip in (False, True):
        for left in range(48):
            if left % 8 < 4:
                for right in range(48):
                    (p, s), (q, t) = M.signed_permutations()[left], M.signed_permutations()[right]
                    cells = [(p[i], q.index(c), s[i] * t[q.index(c)]) for i in range(3) for c in range(3)]
                    rows.append(f"({n}, {flip}, {left}, {right}, [{', '.join(str(1 + (3 * k + i if flip else 3 * i + k)) for i, k, _ in cells)}], [{', '.join(str(float(g)) for _, _, g in cells)}])")
                    n += 1
    return ", ".join(rows)


_TRACE = " + ".join(f"s[{i}] * g[{i}] * a[idx[{i}]]" for i in range(1, 10))
GRAM_SCHMIDT = """g AS (SELECT episode_index, frame_index, r[1:3] AS a, r[4:6] AS b FROM (SELECT episode_index, frame_index, state[11:16] AS r FROM vf)),
 u AS (SELECT episode_index, frame_index, list_transform(a, lambda x: x / greatest(sqrt(list_dot_product(a, a)), 1e-12)) AS x, b FROM g),
 w AS (SELECT episode_index, frame_index, x, list_transform(list_zip(b, x), lambda p: p[1] - list_dot_product(x, b) * p[2]) AS c FROM u),
 y AS (SELECT episode_index, frame_index, x, list_transform(c, lambda t: t / greatest(sqrt(list_dot_product(c, c)), 1e-12)) AS y FROM w),
 m AS (SELECT episode_index, frame_index, x, y, [x[2] * y[3] - x[3] * y[2], x[3] * y[1] - x[1] * y[3], x[1] * y[2] - x[2] * y[1]] AS z FROM y)"""
_OF_ACTION = GRAM_SCHMIDT.replace("state[11:16]", "action[4:9]").replace("FROM g)", "FROM g2)").replace("FROM u)", "FROM u2)").replace("FROM w)", "FROM w2)").replace("FROM y)", "FROM y2)")
for _n in "guwym":
    _OF_ACTION = _OF_ACTION.replace(f"{_n} AS (", f"{_n}2 AS (")
_BEST_ROTATION = f"""{VF}, {GRAM_SCHMIDT}, {_OF_ACTION}, c(candidate, transpose, "left", "right", idx, g) AS (VALUES {_candidates()}),
 p AS (SELECT m.episode_index, list_concat(list_concat(m.x, m.y), m.z) AS s, list_concat(list_concat(m2.x, m2.y), m2.z) AS a FROM m JOIN m2 USING (episode_index, frame_index)),
 h AS (SELECT episode_index, candidate, degrees(acos(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, ({_TRACE} - 1) / 2)))) AS d, s, a FROM p CROSS JOIN c),
 k AS (SELECT episode_index, candidate, avg(d) AS degrees, quantile_cont(d, 0.5) AS p50, quantile_cont(d, 0.95) AS p95, max(d) AS largest FROM h GROUP BY 1, 2),
 r AS (SELECT *, row_number() OVER (PARTITION BY episode_index ORDER BY round(degrees, 9), candidate) AS k FROM k), best AS (SELECT r.*, c.transpose, c."left", c."right" FROM r JOIN c USING (candidate) WHERE k = 1)"""


@query("best_rotation_map", f"""WITH {_BEST_ROTATION} SELECT episode_index, transpose, "left", "right", round(degrees, 6) AS degrees, round(p50, 6) AS p50, round(p95, 6) AS p95, round(largest, 6) AS largest FROM best""")
def best_rotation_map(spark: SparkSession, d: str) -> DataFrame:
    v = vector_frames(spark, d).select(E, "frame_index", F.slice("state", 11, 6).alias("s"), F.slice("action", 4, 6).alias("a"))
    out = M.best_rotation_map(v, "s", "a").drop("rot6d_rmse")
    return out.select(*[r6(c).alias(c) if kind == "double" else c for c, kind in out.dtypes])


@query("hampel_filter")
def hampel_filter(spark: SparkSession, d: str) -> DataFrame:
    s = scalar_frames(spark, d).select(E, "frame_index", F.array("value").alias("x"))
    out = S.smooth_episodes(s, {"x": {"value": (0, 1)}}, S.Smoothing(savgol_window=1))
    return out.select(E, "frame_index", r6(F.col("x")[0]).alias("value"), "hampel_replaced")


@query("smooth_frames")
def smooth_frames(spark: SparkSession, d: str) -> DataFrame:
    groups = {"state": {"arm_joint": (0, 7), "eef_xyz": (7, 10), "eef_rot6d": (10, 16), "hand": (16, 26)}, "action": {"eef_xyz": (0, 3), "eef_rot6d": (3, 9), "hand": (9, 19)}}
    out = S.smooth_episodes(vector_frames(spark, d), groups)
    return out.select(E, "frame_index", F.transform("state", lambda x: F.round(x, 6)).alias("state"), F.transform("action", lambda x: F.round(x, 6)).alias("action"), "hampel_replaced")


def _rotations(spark: SparkSession, d: str) -> DataFrame:
    return vector_frames(spark, d).select(E, "frame_index", F.slice("state", 11, 6).alias("s"), F.slice("action", 4, 6).alias("a"))


@query("rotation_inspection", f"""WITH {_BEST_ROTATION} SELECT e.episode_index, frames, round(direct_mean, 6) AS direct_mean, round(direct_p95, 6) AS direct_p95, round(expected_mean, 6) AS expected_mean, round(expected_p95, 6) AS expected_p95, round(expected_rmse, 6) AS expected_rmse,
 "left" AS best_left, "right" AS best_right, transpose AS best_transpose, round(degrees, 6) AS best_mean, round(p95, 6) AS best_p95, NOT transpose AND "left" = {min(RO.NUMBERS[RO.EXPECTED_LEFT], RO.NUMBERS['-z,-x,-y'])} AND "right" = {RO.NUMBERS['+y,+z,-x']} AS best_is_expected, degrees > {RO.MOST_DEGREES} AS uncertain FROM best
 JOIN (SELECT episode_index, count(*) AS frames, avg(d) AS direct_mean, quantile_cont(d, 0.95) AS direct_p95, avg(e) AS expected_mean, quantile_cont(e, 0.95) AS expected_p95, sqrt(avg(g) / 6) AS expected_rmse FROM (
  SELECT episode_index, degrees(acos(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, (list_dot_product(s, a) - 1) / 2)))) AS d, degrees(acos(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, (list_dot_product(s, m) - 1) / 2)))) AS e, list_distance(s[1:6], m[1:6]) ** 2 AS g
  FROM (SELECT *, [a[9], -a[7], -a[8], a[3], -a[1], -a[2], a[6], -a[4], -a[5]] AS m FROM p)) GROUP BY 1) e USING (episode_index)""")
def rotation_inspection(spark: SparkSession, d: str) -> DataFrame:
    """The inspection table of all episodes, and which of them alone forbid a repair."""
    seen = RO.inspect_rotations(_rotations(spark, d), "s", "a").drop("best_rmse")
    return seen.select(*[r6(c).alias(c) if kind == "double" else c for c, kind in seen.dtypes], (F.col("best_mean") > RO.MOST_DEGREES).alias("uncertain"))


@query("rotation_repair_gate", f"""WITH {_BEST_ROTATION} SELECT count(*) AS episodes, count(*) FILTER (degrees > {RO.MOST_DEGREES}) AS uncertain, CASE WHEN count(*) FILTER (degrees > {RO.MOST_DEGREES}) > 0 THEN 'best_mapping_angle_too_high' END AS reason FROM best""")
def rotation_repair_gate(spark: SparkSession, d: str) -> DataFrame:
    """What the gate says of the whole table: these are no recordings, so it refuses."""
    gate = RO.rotation_gate(RO.inspect_rotations(_rotations(spark, d), "s", "a"))
    return spark.createDataFrame([(gate["episodes"], gate["uncertain"], gate["reason"])], "episodes bigint, uncertain bigint, reason string")


@query("standardise_eef9d", f"""WITH {VF}, {GRAM_SCHMIDT.replace('state[11:16]', 'action[4:9]')}, t AS (SELECT episode_index, frame_index, x, y, z FROM m)
 SELECT vf.episode_index, vf.frame_index, round(action[1], 6) AS px, round(z[3], 6) + 0.0 AS r00, round(-x[3], 6) + 0.0 AS r01, round(-y[3], 6) + 0.0 AS r02, round(z[1], 6) + 0.0 AS r10, round(-x[1], 6) + 0.0 AS r11, round(-y[1], 6) + 0.0 AS r12,
 round(state[11], 6) AS s00 FROM vf JOIN t USING (episode_index, frame_index)""")
def standardise_eef9d(spark: SparkSession, d: str) -> DataFrame:
    """Poses stored by columns in the action's frame, by rows in the state's; and once more with the mark, which changes nothing."""
    v = vector_frames(spark, d)
    once = v.withColumns({"p": RO.standardised(F.slice("action", 1, 9), "column_major", there=False, action=True), "q": RO.standardised(F.slice("state", 8, 9))})
    twice = once.withColumn("p", RO.standardised(F.col("p"), "row_major", there=True, action=True))
    return twice.select(E, "frame_index", r6(F.col("p")[0]).alias("px"), *[r6(F.col("p")[3 + k]).alias(c) for k, c in enumerate(RO.ROW_MAJOR)], r6(F.col("q")[3]).alias("s00"))
