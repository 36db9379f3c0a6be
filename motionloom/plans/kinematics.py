"""Queries on vector and scalar frames: steps, derivatives, statistics, errors, lags, smoothing, relative actions, rotations."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from motionloom.functions import vectors as V
from motionloom.functions.vectors import r6
from motionloom.operators import relative as R
from motionloom.operators import sequences as Q
from motionloom.operators import stats as A
from motionloom.operators.quantiles import summaries
from motionloom.plans.registry import query, sql_of
from motionloom.plans.views import FPS, SFR, VF, read, scalar_frames, vector_frames

E = "episode_index"


def _xyz(column: str, start: int = 0):
    return F.slice(F.col(column), start + 1, 3)


STEP = f"""{VF}, st AS (SELECT *, list_distance(state, lag(state) OVER w) AS step FROM vf WINDOW w AS (PARTITION BY episode_index ORDER BY frame_index))"""


@query("step_l2_stats", f"""WITH {STEP} SELECT episode_index, count(step) AS step_n, round(avg(step), 6) AS step_mean, round(stddev_pop(step), 6) AS step_std,
 round(quantile_cont(step, 0.95), 6) AS step_p95, round(quantile_cont(step, 0.99), 6) AS step_p99, round(max(step), 6) AS step_max FROM st GROUP BY 1""")
def step_l2_stats(spark: SparkSession, d: str) -> DataFrame:
    s = Q.steps(vector_frames(spark, d), F.col("state"), "step")
    out = s.groupBy(E).agg(*A.summary(F.col("step"), "step", ("n", "mean", "std", "p95", "p99", "max")))
    return out.select(E, "step_n", *[r6(f"step_{k}").alias(f"step_{k}") for k in ("mean", "std", "p95", "p99", "max")])



@query("velocity_acc_jerk", f"""WITH {VF},
 v AS (SELECT episode_index, frame_index, CASE WHEN lag(state) OVER w IS NOT NULL THEN list_transform(list_zip(state, lag(state) OVER w), lambda p: (p[1] - p[2]) * 10) END AS x FROM vf WINDOW w AS (PARTITION BY episode_index ORDER BY frame_index)),
 a AS (SELECT episode_index, frame_index, x AS v, CASE WHEN x IS NOT NULL AND lag(x) OVER w IS NOT NULL THEN list_transform(list_zip(x, lag(x) OVER w), lambda p: (p[1] - p[2]) * 10) END AS x FROM v WINDOW w AS (PARTITION BY episode_index ORDER BY frame_index)),
 j AS (SELECT episode_index, v, x AS a, CASE WHEN x IS NOT NULL AND lag(x) OVER w IS NOT NULL THEN list_transform(list_zip(x, lag(x) OVER w), lambda p: (p[1] - p[2]) * 10) END AS j FROM a WINDOW w AS (PARTITION BY episode_index ORDER BY frame_index)),
 n AS (SELECT episode_index, sqrt(list_sum(list_transform(v, lambda t: t * t))) AS v, sqrt(list_sum(list_transform(a, lambda t: t * t))) AS a, sqrt(list_sum(list_transform(j, lambda t: t * t))) AS j FROM j)
 SELECT episode_index, round(avg(v), 6) AS velocity_mean, round(quantile_cont(v, 0.95), 6) AS velocity_p95, round(avg(a), 6) AS acceleration_mean, round(quantile_cont(a, 0.95), 6) AS acceleration_p95,
 round(avg(j), 6) AS jerk_mean, round(max(j), 6) AS jerk_max FROM n GROUP BY 1""")
def velocity_acc_jerk(spark: SparkSession, d: str) -> DataFrame:
    k = Q.derivatives(vector_frames(spark, d), F.col("state"), FPS, "s")
    out = k.groupBy(E).agg(*A.summary(F.col("s_velocity_l2"), "velocity", ("mean", "p95")), *A.summary(F.col("s_acceleration_l2"), "acceleration", ("mean", "p95")), *A.summary(F.col("s_jerk_l2"), "jerk", ("mean", "max")))
    return out.select(E, *[r6(c).alias(c) for c in out.columns if c != E])


@query("finite_summary_by_group", """SELECT l_returnflag, l_linestatus, count(l_extendedprice) AS price_n, round(avg(l_extendedprice), 6) AS price_mean, round(stddev_pop(l_extendedprice), 6) AS price_std,
 round(quantile_cont(l_extendedprice, 0.5), 6) AS price_p50, round(quantile_cont(l_extendedprice, 0.95), 6) AS price_p95, round(quantile_cont(l_extendedprice, 0.99), 6) AS price_p99, round(max(l_extendedprice), 6) AS price_max
 FROM lineitem GROUP BY 1, 2""")
def finite_summary_by_group(spark: SparkSession, d: str) -> DataFrame:
    out = summaries(read(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], F.col("l_extendedprice"), "price", ("n", "mean", "std", "p50", "p95", "p99", "max"))
    return out.select("l_returnflag", "l_linestatus", "price_n", *[r6(f"price_{k}").alias(f"price_{k}") for k in ("mean", "std", "p50", "p95", "p99", "max")])


@query("vector_stats_per_dim", f"""WITH {VF}, x AS (SELECT generate_subscripts(state, 1) - 1 AS dim, unnest(state) AS x FROM vf)
 SELECT CAST(dim AS INTEGER) AS dim, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, round(min(x), 6) AS min, round(max(x), 6) AS max, round(quantile_cont(x, 0.01), 6) AS q01, round(quantile_cont(x, 0.99), 6) AS q99 FROM x GROUP BY 1""")
def vector_stats_per_dim(spark: SparkSession, d: str) -> DataFrame:
    out = A.vector_stats(vector_frames(spark, d), "state")
    return out.select("dim", *[r6(c).alias(c) for c in out.columns if c != "dim"])


@query("state_action_rmse", f"""WITH {VF}, x AS (SELECT episode_index, generate_subscripts(action, 1) - 1 AS dim, unnest(action) AS a, unnest(state[8:26]) AS s FROM vf),
 p AS (SELECT episode_index, dim, sqrt(avg((s - a) * (s - a))) AS r FROM x GROUP BY 1, 2), o AS (SELECT episode_index, sqrt(avg((s - a) * (s - a))) AS r FROM x GROUP BY 1)
 SELECT p.episode_index, round(max(o.r), 6) AS rmse, round(max(p.r), 6) AS worst_rmse, CAST(arg_max(p.dim, (p.r, -p.dim)) AS INTEGER) AS worst_dim FROM p JOIN o USING (episode_index) GROUP BY 1""")
def state_action_rmse(spark: SparkSession, d: str) -> DataFrame:
    """Errors of the 19 shared dimensions: one over all differences, and the worst dimension's."""
    pairs = vector_frames(spark, d).select(E, F.posexplode(F.arrays_zip(F.slice("state", 8, 19).alias("s"), F.col("action").alias("a"))).alias("dim", "p"))
    sq = pairs.select(E, "dim", ((F.col("p.s") - F.col("p.a")) ** 2).alias("sq"))
    per = sq.groupBy(E, "dim").agg(F.sum("sq").alias("total"), F.count("sq").alias("n"))
    out = per.groupBy(E).agg(F.sqrt(F.sum("total") / F.sum("n")).alias("rmse"), F.max(F.sqrt(F.col("total") / F.col("n"))).alias("worst_rmse"), A.first_by(F.col("dim"), F.sqrt(F.col("total") / F.col("n")), F.col("dim")).alias("worst_dim"))
    return out.select(E, r6("rmse").alias("rmse"), r6("worst_rmse").alias("worst_rmse"), "worst_dim")


LAGS = f"""{VF}, s AS (SELECT episode_index, frame_index AS t, list_distance(state, lag(state) OVER w) AS ss, list_distance(action, lag(action) OVER w) AS aa FROM vf WINDOW w AS (PARTITION BY episode_index ORDER BY frame_index)),
 l AS (SELECT CAST(unnest(range(-20, 21)) AS INTEGER) AS lag)"""


@query("lag_by_corr", f"""WITH {LAGS}, c AS (SELECT a.episode_index, l.lag, count(*) AS n, corr(a.aa, b.ss) AS c FROM s a CROSS JOIN l JOIN s b ON a.episode_index = b.episode_index AND b.t = a.t + l.lag
 WHERE a.aa IS NOT NULL AND b.ss IS NOT NULL GROUP BY 1, 2)
 SELECT episode_index, arg_max(lag, (round(c, 9), -lag)) AS lag, round(max(c), 6) AS corr FROM c WHERE n >= 4 AND c IS NOT NULL AND NOT isnan(c) GROUP BY 1""")
def lag_by_corr(spark: SparkSession, d: str) -> DataFrame:
    v = vector_frames(spark, d)
    s = Q.steps(Q.steps(v, F.col("state"), "ss"), F.col("action"), "aa")
    return Q.lag_by_correlation(s, F.col("aa"), F.col("ss")).select(E, "lag", r6("corr").alias("corr"))


@query("lag_by_rmse", f"""WITH {VF}, l AS (SELECT CAST(unnest(range(-5, 6)) AS INTEGER) AS lag),
 c AS (SELECT a.episode_index, l.lag, count(*) AS n, sqrt(sum(list_distance(a.action[1:3], b.state[8:10]) ** 2) / (3 * count(*))) AS r FROM vf a CROSS JOIN l JOIN vf b ON a.episode_index = b.episode_index AND b.frame_index = a.frame_index + l.lag GROUP BY 1, 2)
 SELECT episode_index, arg_min(lag, (round(r, 9), lag)) AS lag, round(min(r), 6) AS rmse FROM c WHERE n >= 2 GROUP BY 1""")
def lag_by_rmse(spark: SparkSession, d: str) -> DataFrame:
    return Q.lag_by_rmse(vector_frames(spark, d), _xyz("action"), _xyz("state", 7), 5).select(E, "lag", r6("rmse").alias("rmse"))


@query("lag_by_rmse_20", sql_of("lag_by_rmse").replace("range(-5, 6)", "range(-20, 21)"))
def lag_by_rmse_20(spark: SparkSession, d: str) -> DataFrame:
    """lag_by_rmse over the reference's lags; the SQL of lag_by_rmse stops at 5."""
    return Q.lag_by_rmse(vector_frames(spark, d), _xyz("action"), _xyz("state", 7)).select(E, "lag", r6("rmse").alias("rmse"))


@query("longest_run_closing", f"""WITH {SFR}, m AS (SELECT episode_index, frame_index, value - lag(value) OVER (PARTITION BY episode_index ORDER BY frame_index) AS v FROM sfr),
 q AS (SELECT episode_index, greatest(1e-6, quantile_cont(abs(v), 0.75)) AS lim FROM m GROUP BY 1),
 f AS (SELECT m.episode_index, m.frame_index, coalesce(m.v > q.lim, false) AS c FROM m JOIN q USING (episode_index)),
 g AS (SELECT *, row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) - row_number() OVER (PARTITION BY episode_index, c ORDER BY frame_index) AS i FROM f),
 h AS (SELECT episode_index, c, i, count(*) AS n FROM g GROUP BY 1, 2, 3)
 SELECT episode_index, max(CASE WHEN c THEN n ELSE 0 END) AS run, round(max(CASE WHEN c THEN n ELSE 0 END) / 10.0::DOUBLE, 6) AS closing_duration FROM h GROUP BY 1""")
def longest_run_closing(spark: SparkSession, d: str) -> DataFrame:
    s = scalar_frames(spark, d)
    v = s.select(E, "frame_index", (F.col("value") - F.lag("value").over(Q.order())).alias("v"))
    lim = F.greatest(F.lit(1e-6), F.percentile(F.abs("v"), F.lit(0.75)).over(Window.partitionBy(E)))
    runs = Q.longest_run(v.withColumn("lim", lim), F.col("v") > F.col("lim"))
    return runs.select(E, F.col("run").cast("bigint").alias("run"), r6(F.col("run") / FPS).alias("closing_duration"))


@query("holding_stability", f"""WITH {VF}, t AS (SELECT episode_index, state, row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) - 1 AS p, count(*) OVER (PARTITION BY episode_index) AS n FROM vf),
 x AS (SELECT episode_index, generate_subscripts(state[17:26], 1) AS dim, unnest(state[17:26]) AS x FROM t WHERE p >= floor(n * 0.8::DOUBLE)), y AS (SELECT episode_index, dim, stddev_pop(x) AS s FROM x GROUP BY 1, 2)
 SELECT episode_index, round(avg(s), 6) AS holding_std FROM y GROUP BY 1""")
def holding_stability(spark: SparkSession, d: str) -> DataFrame:
    last = Q.tail(vector_frames(spark, d)).select(E, F.posexplode(F.slice("state", 17, 10)).alias("dim", "x"))
    return last.groupBy(E, "dim").agg(F.stddev_pop("x").alias("s")).groupBy(E).agg(r6(F.avg("s")).alias("holding_std"))


def _derived(prefix: str, column: str, orders: int = 3) -> str:
    """velocity, acceleration and jerk of a vector expression as chained views."""
    out, last = [], f"SELECT episode_index, frame_index, {column} AS x FROM vf"
    for n in range(orders):
        step = f"SELECT episode_index, frame_index, CASE WHEN lag(x) OVER w IS NOT NULL THEN list_transform(list_zip(x, lag(x) OVER w), lambda p: (p[1] - p[2]) * 10) END AS x FROM ({last}) WINDOW w AS (PARTITION BY episode_index ORDER BY frame_index)"
        out.append(f"{prefix}{n} AS ({step})")
        last = f"SELECT * FROM {prefix}{n} WHERE x IS NOT NULL"
    return ", ".join(out)


#: Hand metrics from their definition: components, not row norms; finite values only.
_HAND = f"""{_derived('h', 'state[17:26]', 2)}, hx AS (SELECT episode_index, x FROM (SELECT episode_index, unnest(state[17:26]) AS x FROM vf) WHERE isfinite(x)),
 hv AS (SELECT episode_index, quantile_cont(abs(x), 0.95) AS p FROM (SELECT episode_index, unnest(x) AS x FROM h0) WHERE isfinite(x) GROUP BY 1), ha AS (SELECT episode_index, quantile_cont(abs(x), 0.95) AS p FROM (SELECT episode_index, unnest(x) AS x FROM h1) WHERE isfinite(x) GROUP BY 1),
 hp AS (SELECT episode_index, frame_index, list_avg(x) AS v FROM h0 WHERE x IS NOT NULL), hl AS (SELECT episode_index, greatest(1e-6, quantile_cont(abs(v), 0.75)) AS lim FROM hp GROUP BY 1),
 hf AS (SELECT hp.episode_index, frame_index, v > lim AS c FROM hp JOIN hl USING (episode_index)), hg AS (SELECT *, row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) - row_number() OVER (PARTITION BY episode_index, c ORDER BY frame_index) AS i FROM hf),
 hr AS (SELECT episode_index, max(n) AS run FROM (SELECT episode_index, count(*) AS n FROM hg WHERE c GROUP BY episode_index, i) GROUP BY 1),
 ht AS (SELECT episode_index, state[17:26] AS s, row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) - 1 AS p, count(*) OVER (PARTITION BY episode_index) AS n FROM vf),
 hs AS (SELECT episode_index, avg(s) AS s FROM (SELECT episode_index, d, stddev_pop(x) AS s FROM (SELECT episode_index, generate_subscripts(s, 1) AS d, unnest(s) AS x FROM ht WHERE p >= floor(n * 0.8::DOUBLE)) WHERE isfinite(x) GROUP BY 1, 2) GROUP BY 1),
 hm AS (SELECT hx.episode_index, round(min(x), 6) AS finger_angle_min, round(max(x), 6) AS finger_angle_max, round(avg(x), 6) AS finger_angle_mean, round(stddev_pop(x), 6) AS finger_angle_std, round(any_value(hv.p), 6) AS finger_velocity_p95, round(any_value(ha.p), 6) AS finger_acceleration_p95,
  round(avg(CASE WHEN abs(x) <= 1e-6 THEN 1.0::DOUBLE ELSE 0 END), 6) AS zero_ratio, round(avg(CASE WHEN abs(x) >= 0.98::DOUBLE THEN 1.0::DOUBLE ELSE 0 END), 6) AS saturation_ratio, round(coalesce(any_value(hr.run), 0) / 10.0::DOUBLE, 6) AS closing_duration, round(any_value(hs.s), 6) AS holding_stability
  FROM hx LEFT JOIN hv USING (episode_index) LEFT JOIN ha USING (episode_index) LEFT JOIN hr USING (episode_index) LEFT JOIN hs USING (episode_index) GROUP BY 1)"""


@query("hand_metrics", f"WITH {VF}, {_HAND} SELECT * FROM hm")
def hand_metrics(spark: SparkSession, d: str) -> DataFrame:
    from motionloom.operators.hand import METRICS, hand_metrics

    return hand_metrics(vector_frames(spark, d), F.slice("state", 17, 10), FPS).select(E, *[r6(c).alias(c) for c in METRICS])


@query("path_metrics", f"""WITH {VF}, s AS (SELECT episode_index, frame_index, state[8:10] AS p, list_distance(state[8:10], lag(state[8:10]) OVER (PARTITION BY episode_index ORDER BY frame_index)) AS s FROM vf),
 g AS (SELECT episode_index, sum(s) AS len, list_distance(arg_min(p, frame_index), arg_max(p, frame_index)) AS disp, avg(CASE WHEN s IS NULL THEN NULL WHEN s < 0.25::DOUBLE THEN 1.0::DOUBLE ELSE 0 END) AS pause FROM s GROUP BY 1)
 SELECT episode_index, round(len, 6) AS path_length, round(disp, 6) AS displacement, round(disp / greatest(len, 1e-8), 6) AS straightness, round(pause, 6) AS pause_ratio FROM g""")
def path_metrics(spark: SparkSession, d: str) -> DataFrame:
    out = R.path_metrics(vector_frames(spark, d), _xyz("state", 7), pause=0.25)
    return out.select(E, *[r6(c).alias(c) for c in out.columns if c != E])


@query("downsample_series", f"""WITH {SFR}, n AS (SELECT *, count(*) OVER (PARTITION BY episode_index) AS n FROM sfr), k AS (SELECT unnest(range(0, 24)) AS k)
 SELECT episode_index, frame_index, round(value, 6) AS value FROM n WHERE n <= 24 OR frame_index IN (SELECT CAST(floor((n.n - 1) * k / 23.0::DOUBLE) AS BIGINT) FROM k)""")
def downsample_series(spark: SparkSession, d: str) -> DataFrame:
    return Q.downsample(scalar_frames(spark, d), 24).select(E, "frame_index", r6("value").alias("value"))


@query("trim_renumber", f"""WITH {VF}, k AS (SELECT episode_index, frame_index, state, row_number() OVER w - 1 AS i, lead(frame_index) OVER w IS NULL AS done FROM vf WHERE frame_index BETWEEN 5 AND 29 WINDOW w AS (PARTITION BY episode_index ORDER BY frame_index))
 SELECT episode_index, i AS frame_index, round(i / 10.0::DOUBLE, 6) AS timestamp, done, round(state[1], 6) AS first FROM k""")
def trim_renumber(spark: SparkSession, d: str) -> DataFrame:
    return Q.trim(vector_frames(spark, d), 5, 29, FPS).select(E, "frame_index", r6("timestamp").alias("timestamp"), "done", r6(F.col("state")[0]).alias("first"))


#: Those of the reference. The SQL of the older queries stops before; the queries NAME_all_horizons have all.
HORIZONS = (1, 2, 4, 8, 16, 32)


def _all_horizons(sql: str, shorter: str) -> str:
    assert sql.count(shorter) == 1
    return sql.replace(shorter, str(list(HORIZONS)))


BEFORE_AFTER = f"""{VF}, ba AS (SELECT episode_index, frame_index, action AS b, list_transform(list_zip(coalesce(lag(action) OVER w, action), action, coalesce(lead(action) OVER w, action)), lambda p: (p[1] + p[2] + p[3]) / 3) AS a
 FROM vf WINDOW w AS (PARTITION BY episode_index ORDER BY frame_index))"""


def before_after(spark: SparkSession, d: str) -> DataFrame:
    """Actions and a smoothed copy: the mean of three neighbours."""
    v = vector_frames(spark, d)
    prev, nxt = F.coalesce(F.lag("action").over(Q.order()), F.col("action")), F.coalesce(F.lead("action").over(Q.order()), F.col("action"))
    mean = F.zip_with(F.zip_with(prev, F.col("action"), lambda x, y: x + y), nxt, lambda s, z: (s + z) / 3)
    return v.select(E, "frame_index", F.col("action").alias("before"), mean.alias("after"))


@query("smoothing_change", f"""WITH {BEFORE_AFTER}, x AS (SELECT episode_index, generate_subscripts(a, 1) - 1 AS dim, unnest(a) - unnest(b) AS x FROM ba)
 SELECT episode_index, CASE WHEN dim < 3 THEN 'eef_xyz' WHEN dim < 9 THEN 'eef_rot6d' WHEN dim < 19 THEN 'hand_joint_target' ELSE 'arm_joint_target' END AS action_group, round(avg(abs(x)), 6) AS mean_abs, round(max(abs(x)), 6) AS max_abs, round(sqrt(avg(x * x)), 6) AS rms FROM x GROUP BY 1, 2""")
def smoothing_change(spark: SparkSession, d: str) -> DataFrame:
    from motionloom.functions.text import action_group

    x = before_after(spark, d).select(E, F.posexplode(V.minus(F.col("after"), F.col("before"))).alias("dim", "x"))
    return x.groupBy(E, action_group(F.col("dim")).alias("action_group")).agg(r6(F.avg(F.abs("x"))).alias("mean_abs"), r6(F.max(F.abs("x"))).alias("max_abs"), r6(A.rmse(F.col("x"))).alias("rms"))


@query("before_after_diff_by_horizon", f"""WITH {BEFORE_AFTER}, h AS (SELECT unnest([1, 2, 4, 8]) AS horizon),
 r AS (SELECT x.episode_index, h.horizon, list_distance(list_transform(list_zip(y.a[1:3], x.a[1:3]), lambda p: p[1] - p[2]), list_transform(list_zip(y.b[1:3], x.b[1:3]), lambda p: p[1] - p[2])) AS d
 FROM ba x CROSS JOIN h JOIN ba y ON x.episode_index = y.episode_index AND y.frame_index = x.frame_index + h.horizon)
 SELECT horizon, count(d) AS diff_n, round(avg(d), 6) AS diff_mean, round(quantile_cont(d, 0.5), 6) AS diff_p50, round(quantile_cont(d, 0.95), 6) AS diff_p95, round(max(d), 6) AS diff_max FROM r GROUP BY 1""")
def before_after_diff_by_horizon(spark: SparkSession, d: str, horizons: tuple[int, ...] = (1, 2, 4, 8)) -> DataFrame:
    both = before_after(spark, d).select(E, "frame_index", F.concat(F.slice("before", 1, 3), F.slice("after", 1, 3)).alias("v"))
    rel = R.relative_vector(R.ahead(both, "v", horizons))
    diff = V.norm(V.minus(F.slice("rel", 4, 3), F.slice("rel", 1, 3)))
    out = summaries(rel, ["horizon"], diff, "diff", ("n", "mean", "p50", "p95", "max"))
    return out.select("horizon", "diff_n", *[r6(f"diff_{k}").alias(f"diff_{k}") for k in ("mean", "p50", "p95", "max")])


REL = f"""{VF}, h AS (SELECT CAST(unnest([1, 2, 4, 8, 16]) AS INTEGER) AS horizon),
 r AS MATERIALIZED (SELECT episode_index, frame_index, horizon, list_transform(list_zip(y, x), lambda p: p[1] - p[2]) AS rel FROM (
  SELECT episode_index, frame_index, horizon, action[10:19] AS x, lead(action[10:19], horizon) OVER (PARTITION BY episode_index, horizon ORDER BY frame_index) AS y FROM vf CROSS JOIN h) WHERE y IS NOT NULL),
 l AS MATERIALIZED (SELECT episode_index, frame_index, horizon, CAST(generate_subscripts(rel, 1) - 1 AS INTEGER) AS dim, unnest(rel) AS value FROM r),
 b AS (SELECT horizon, dim, quantile_cont(value, 0.01) AS q01, quantile_cont(value, 0.99) AS q99 FROM l GROUP BY 1, 2),
 c AS (SELECT l.*, q01, q99, 2 * (value - q01) / greatest(q99 - q01, 1e-8) - 1 AS norm FROM l JOIN b USING (horizon, dim))"""


def _hand_relative(spark: SparkSession, d: str, horizons: tuple[int, ...] = (1, 2, 4, 8, 16)) -> DataFrame:
    hand = vector_frames(spark, d).select(E, "frame_index", F.slice("action", 10, 10).alias("hand"))
    return R.relative_vector(R.ahead(hand, "hand", horizons))


@query("relative_horizon_stats", f"""WITH {REL}, n AS (SELECT horizon, sqrt(list_sum(list_transform(rel, lambda x: x * x))) AS x FROM r)
 SELECT horizon, count(x) AS rel_n, round(avg(x), 6) AS rel_mean, round(quantile_cont(x, 0.5), 6) AS rel_p50, round(quantile_cont(x, 0.95), 6) AS rel_p95, round(quantile_cont(x, 0.99), 6) AS rel_p99, round(max(x), 6) AS rel_max FROM n GROUP BY 1""")
def relative_horizon_stats(spark: SparkSession, d: str, horizons: tuple[int, ...] = (1, 2, 4, 8, 16)) -> DataFrame:
    out = summaries(_hand_relative(spark, d, horizons), ["horizon"], V.norm(F.col("rel")), "rel", ("n", "mean", "p50", "p95", "p99", "max"))
    return out.select("horizon", "rel_n", *[r6(f"rel_{k}").alias(f"rel_{k}") for k in ("mean", "p50", "p95", "p99", "max")])


@query("clip_ratio", f"WITH {REL} SELECT episode_index, horizon, CAST(sum(CASE WHEN abs(norm) > 1 THEN 1 ELSE 0 END) AS BIGINT) AS clipped, count(*) AS values, round(avg(CASE WHEN abs(norm) > 1 THEN 1.0::DOUBLE ELSE 0 END), 6) AS ratio FROM c GROUP BY 1, 2")
def clip_ratio(spark: SparkSession, d: str, horizons: tuple[int, ...] = (1, 2, 4, 8, 16)) -> DataFrame:
    rel = _hand_relative(spark, d, horizons)
    return R.clip_ratio(R.against_bounds(rel, R.bounds(rel)), (E, "horizon")).select(E, "horizon", "clipped", "values", r6("ratio").alias("ratio"))


@query("clipped_rows", f"""WITH {REL} SELECT episode_index, frame_index AS start, horizon, dim, CASE WHEN norm < -1 THEN 'low' ELSE 'high' END AS side, round(value, 6) AS value,
 round(CASE WHEN norm < -1 THEN q01 - value ELSE value - q99 END, 6) AS excess FROM c WHERE abs(norm) > 1""")
def clipped_rows(spark: SparkSession, d: str, horizons: tuple[int, ...] = (1, 2, 4, 8, 16)) -> DataFrame:
    rel = _hand_relative(spark, d, horizons)
    out = R.clipped_rows(R.against_bounds(rel, R.bounds(rel)))
    return out.select(E, F.col("frame_index").alias("start"), "horizon", "dim", "side", r6("value").alias("value"), r6("excess").alias("excess"))


@query("clipped_by_group_side", f"""WITH {REL}, s AS (SELECT CASE WHEN dim < 5 THEN 'thumb_index' ELSE 'other' END AS action_group, norm FROM c WHERE abs(norm) > 1)
 SELECT action_group, count(*) FILTER (norm > 1) AS high, count(*) FILTER (norm < -1) AS low FROM s GROUP BY 1""")
def clipped_by_group_side(spark: SparkSession, d: str, horizons: tuple[int, ...] = (1, 2, 4, 8, 16)) -> DataFrame:
    rel = _hand_relative(spark, d, horizons)
    rows = R.clipped_rows(R.against_bounds(rel, R.bounds(rel)))
    return rows.groupBy(F.when(F.col("dim") < 5, "thumb_index").otherwise("other").alias("action_group")).pivot("side", ["high", "low"]).agg(F.count(F.lit(1))).na.fill(0)


GS = """g AS (SELECT episode_index, frame_index, r[1:3] AS a, r[4:6] AS b FROM (SELECT episode_index, frame_index, state[11:16] AS r FROM vf)),
 u AS (SELECT episode_index, frame_index, list_transform(a, lambda x: x / greatest(sqrt(list_dot_product(a, a)), 1e-12)) AS x, b FROM g),
 w AS (SELECT episode_index, frame_index, x, list_transform(list_zip(b, x), lambda p: p[1] - list_dot_product(x, b) * p[2]) AS c FROM u),
 y AS (SELECT episode_index, frame_index, x, list_transform(c, lambda t: t / greatest(sqrt(list_dot_product(c, c)), 1e-12)) AS y FROM w),
 m AS (SELECT episode_index, frame_index, x, y, [x[2] * y[3] - x[3] * y[2], x[3] * y[1] - x[1] * y[3], x[1] * y[2] - x[2] * y[1]] AS z FROM y)"""


@query("rot6d_validity", f"""WITH {VF}, v AS (SELECT episode_index, abs(sqrt(list_dot_product(state[11:13], state[11:13])) - 1) AS a, abs(sqrt(list_dot_product(state[14:16], state[14:16])) - 1) AS b, abs(list_dot_product(state[11:13], state[14:16])) AS c FROM vf)
 SELECT episode_index, round(avg(a), 6) AS first_mean, round(max(b), 6) AS second_max, round(quantile_cont(c, 0.95), 6) AS product_p95 FROM v GROUP BY 1""")
def rot6d_validity(spark: SparkSession, d: str) -> DataFrame:
    v = vector_frames(spark, d).select(E, R.rot6d_validity(F.slice("state", 11, 6)).alias("v"))
    return v.groupBy(E).agg(r6(F.avg("v.first")).alias("first_mean"), r6(F.max("v.second")).alias("second_max"), r6(F.percentile("v.product", F.lit(0.95))).alias("product_p95"))


@query("rot6d_step_angle", f"""WITH {VF}, {GS}, t AS (SELECT episode_index, list_dot_product(x, lag(x) OVER o) + list_dot_product(y, lag(y) OVER o) + list_dot_product(z, lag(z) OVER o) AS t FROM m WINDOW o AS (PARTITION BY episode_index ORDER BY frame_index)),
 d AS (SELECT episode_index, degrees(acos(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, (t - 1) / 2)))) AS d FROM t WHERE t IS NOT NULL)
 SELECT episode_index, round(avg(d), 5) AS angle_mean, round(quantile_cont(d, 0.95), 5) AS angle_p95, round(max(d), 5) AS angle_max FROM d GROUP BY 1""")
def rot6d_step_angle(spark: SparkSession, d: str) -> DataFrame:
    rows = vector_frames(spark, d).select(E, "frame_index", V.rot6d_rows(F.slice("state", 11, 6)).alias("r"))
    turned = rows.select(E, V.rotation_between(F.lag("r").over(Q.order()), F.col("r")).alias("a")).where("a IS NOT NULL")
    out = turned.groupBy(E).agg(*A.summary(F.col("a"), "angle", ("mean", "p95", "max")))
    return out.select(E, *[F.round(c, 5).alias(c) for c in out.columns if c != E])


@query("quat_to_rot6d", f"""WITH {VF}, q AS (SELECT episode_index, frame_index, action[1:4] AS q FROM vf), n AS (SELECT episode_index, frame_index, q[1] / n AS x, q[2] / n AS y, q[3] / n AS z, q[4] / n AS w FROM (SELECT *, sqrt(list_dot_product(q, q)) AS n FROM q))
 SELECT episode_index, frame_index, round(1 - 2 * (y * y + z * z), 6) AS r00, round(2 * (x * y - z * w), 6) AS r01, round(2 * (x * z + y * w), 6) AS r02, round(1 - 2 * (x * x + y * y), 6) AS a0, round(-(2 * (x * z - y * w)), 6) AS a1, round(-(1 - 2 * (y * y + z * z)), 6) AS a4 FROM n""")
def quat_to_rot6d(spark: SparkSession, d: str) -> DataFrame:
    q = vector_frames(spark, d).select(E, "frame_index", V.quaternion_to_rot6d(F.slice("action", 1, 4)).alias("r"), V.action_quaternion_to_rot6d(F.slice("action", 1, 4)).alias("a"))
    return q.select(E, "frame_index", *[F.round(F.col("r")[i], 6).alias(f"r0{i}") for i in range(3)], F.round(F.col("a")[0], 6).alias("a0"), F.round(F.col("a")[1], 6).alias("a1"), F.round(F.col("a")[4], 6).alias("a4"))


@query("relative_pose_by_horizon", f"""WITH {VF}, {GS}, p AS (SELECT m.*, vf.state[8:10] AS p FROM m JOIN vf USING (episode_index, frame_index)), h AS (SELECT CAST(unnest([1, 4]) AS INTEGER) AS horizon),
 j AS (SELECT h.horizon, a.x, a.y, a.z, list_transform(list_zip(b.p, a.p), lambda q: q[1] - q[2]) AS d, list_dot_product(a.x, b.x) + list_dot_product(a.y, b.y) + list_dot_product(a.z, b.z) AS t FROM p a CROSS JOIN h JOIN p b ON a.episode_index = b.episode_index AND b.frame_index = a.frame_index + h.horizon)
 SELECT horizon, round(avg(x[1] * d[1] + y[1] * d[2] + z[1] * d[3]), 6) AS forward_mean, round(max(sqrt(list_dot_product(d, d))), 6) AS move_max, round(avg(degrees(acos(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, (t - 1) / 2))))), 5) AS degrees_mean FROM j GROUP BY 1""")
def relative_pose_by_horizon(spark: SparkSession, d: str, horizons: tuple[int, ...] = (1, 4)) -> DataFrame:
    eef = vector_frames(spark, d).select(E, "frame_index", F.slice("state", 8, 9).alias("eef"))
    rel = R.ahead(eef, "eef", horizons).select("horizon", R.relative_pose(F.col("now"), F.col("then")).alias("p"))
    return rel.groupBy("horizon").agg(r6(F.avg(F.col("p.move")[0])).alias("forward_mean"), r6(F.max(V.norm(F.col("p.move")))).alias("move_max"), F.round(F.avg("p.degrees"), 5).alias("degrees_mean"))


@query("hand_ahead_of_state", f"""WITH {VF}, h AS (SELECT CAST(unnest([1, 2, 4, 8, 16, 32]) AS INTEGER) AS horizon),
 j AS (SELECT h.horizon, list_transform(list_zip(b.action[10:19], a.state[17:26]), lambda q: q[1] - q[2]) AS rel FROM vf a CROSS JOIN h JOIN vf b ON a.episode_index = b.episode_index AND b.frame_index = a.frame_index + h.horizon - 1)
 SELECT horizon, count(*) AS pairs, round(avg(sqrt(list_dot_product(rel, rel))), 6) AS mean, round(max(sqrt(list_dot_product(rel, rel))), 6) AS most FROM j GROUP BY 1""")
def hand_ahead_of_state(spark: SparkSession, d: str) -> DataFrame:
    hand = vector_frames(spark, d).select(E, "frame_index", F.slice("state", 17, 10).alias("own"), F.slice("action", 10, 10).alias("sent"))
    far = V.norm(F.col("rel"))
    return R.relative_vector(R.ahead_of_state(hand, "own", "sent", HORIZONS)).groupBy("horizon").agg(F.count(F.lit(1)).alias("pairs"), r6(F.avg(far)).alias("mean"), r6(F.max(far)).alias("most"))


def _register_all_horizons() -> None:
    """Each horizon query again as NAME_all_horizons, over HORIZONS in code and SQL."""
    shorter = {relative_horizon_stats: "[1, 2, 4, 8, 16]", clip_ratio: "[1, 2, 4, 8, 16]", clipped_rows: "[1, 2, 4, 8, 16]", clipped_by_group_side: "[1, 2, 4, 8, 16]", before_after_diff_by_horizon: "[1, 2, 4, 8]", relative_pose_by_horizon: "[1, 4]"}
    for f, old in shorter.items():
        query(f"{f.__name__}_all_horizons", _all_horizons(sql_of(f.__name__), old))(functools.partial(f, horizons=HORIZONS))


_register_all_horizons()


def _savgol_sql() -> str:
    weights = [[16 / 21, 5 / 14, 1 / 14, -2 / 21, -1 / 7, -1 / 14, 5 / 42], [5 / 14, 2 / 7, 3 / 14, 1 / 7, 1 / 14, 0.0, -1 / 14], [1 / 14, 3 / 14, 2 / 7, 2 / 7, 3 / 14, 1 / 14, -1 / 7], [-2 / 21, 3 / 21, 6 / 21, 7 / 21, 6 / 21, 3 / 21, -2 / 21]]
    weights += [list(reversed(r)) for r in reversed(weights[:3])]
    lists = ", ".join("[" + ", ".join(f"CAST({x!r} AS DOUBLE)" for x in r) + "]" for r in weights)
    return f"""WITH {SFR}, a AS (SELECT episode_index, list(value ORDER BY frame_index) AS v, count(*) AS n FROM sfr GROUP BY 1),
 p AS (SELECT s.episode_index, s.frame_index, a.v, a.n, CAST(greatest(0, least(s.frame_index - 3, a.n - 7)) AS BIGINT) AS b FROM sfr s JOIN a USING (episode_index) WHERE a.n >= 7)
 SELECT episode_index, frame_index, round(list_dot_product(v[b + 1 : b + 7], ([{lists}])[frame_index - b + 1]), 6) AS smooth FROM p"""


@query("savgol_smooth", _savgol_sql())
def savgol_smooth(spark: SparkSession, d: str) -> DataFrame:
    s = Q.savgol(scalar_frames(spark, d), "value", "smooth").withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(E)))
    return s.where("n >= 7").select(E, "frame_index", r6("smooth").alias("smooth"))


def _savgol_short_sql() -> str:
    """The episodes that savgol_smooth's SQL leaves out: window 5 for 5 and 6 frames, unchanged below."""
    weights = [[31 / 35, 9 / 35, -3 / 35, -5 / 35, 3 / 35], [9 / 35, 13 / 35, 12 / 35, 6 / 35, -5 / 35], [-3 / 35, 12 / 35, 17 / 35, 12 / 35, -3 / 35]]
    weights += [list(reversed(r)) for r in reversed(weights[:2])]
    lists = ", ".join("[" + ", ".join(f"CAST({x!r} AS DOUBLE)" for x in r) + "]" for r in weights)
    return f""" UNION ALL SELECT episode_index, frame_index, round(list_dot_product(v[b + 1 : b + 5], ([{lists}])[frame_index - b + 1]), 6)
 FROM (SELECT s.episode_index, s.frame_index, a.v, CAST(greatest(0, least(s.frame_index - 2, a.n - 5)) AS BIGINT) AS b FROM sfr s JOIN a USING (episode_index) WHERE a.n IN (5, 6))
 UNION ALL SELECT s.episode_index, s.frame_index, round(s.value, 6) FROM sfr s JOIN a USING (episode_index) WHERE a.n < 5"""


@query("savgol_smooth_every_episode", _savgol_sql() + _savgol_short_sql())
def savgol_smooth_every_episode(spark: SparkSession, d: str) -> DataFrame:
    """savgol_smooth without its limit to 7 frames and more."""
    return Q.savgol(scalar_frames(spark, d), "value", "smooth").select(E, "frame_index", r6("smooth").alias("smooth"))


@query("first_mean_vs_max", f"""WITH {SFR} SELECT episode_index, round(avg(CASE WHEN frame_index < 10 THEN value END), 6) AS first_mean, round(max(value), 6) AS max_value, arg_max(frame_index, (value, -frame_index)) AS max_frame FROM sfr GROUP BY 1""")
def first_mean_vs_max(spark: SparkSession, d: str) -> DataFrame:
    s = scalar_frames(spark, d)
    return s.groupBy(E).agg(r6(F.avg(F.when(F.col("frame_index") < 10, F.col("value")))).alias("first_mean"), r6(F.max("value")).alias("max_value"), A.first_by(F.col("frame_index"), F.col("value"), F.col("frame_index")).alias("max_frame"))


@query("state_action_corr", f"""WITH {VF}, x AS (SELECT episode_index, state[8] AS a, action[1] AS b FROM vf) SELECT episode_index, round(corr(a, b), 6) AS corr, count(*) AS n FROM x GROUP BY 1""")
def state_action_corr(spark: SparkSession, d: str) -> DataFrame:
    v = vector_frames(spark, d).select(E, F.col("state")[7].alias("a"), F.col("action")[0].alias("b"))
    return v.groupBy(E).agg(r6(A.guarded_corr(F.col("a"), F.col("b"))).alias("corr"), F.count(F.lit(1)).alias("n"))


_L2 = "sqrt(list_sum(list_transform(x, lambda t: t * t)))"


def _gate_groups() -> tuple[str, str]:
    """Views and joined columns of the 95th percentiles of velocity, acceleration and jerk norms of all groups, and of steps."""
    views, columns = [], []
    for k, (g, column) in enumerate({"arm_joint": "state[1:7]", "eef_state": "state[8:16]", "hand_state": "state[17:26]", "eef_action": "action[1:9]", "hand_action": "action[10:19]"}.items()):
        views.append(_derived(f"g{k}_", column))
        for n, name in enumerate(("velocity", "acceleration", "jerk")):
            views.append(f"q{k}{n} AS (SELECT episode_index, round(quantile_cont({_L2}, 0.95), 6) AS {g}_{name}_l2_p95 FROM g{k}_{n} GROUP BY 1)")
            columns.append(f"JOIN q{k}{n} USING (episode_index)")
    for c in ("state", "action"):
        views.append(f"s_{c} AS (SELECT episode_index, round(quantile_cont(x, 0.95), 6) AS {c}_step_l2_p95 FROM (SELECT episode_index, list_distance({c}, lag({c}) OVER (PARTITION BY episode_index ORDER BY frame_index)) AS x FROM vf) GROUP BY 1)")
        columns.append(f"JOIN s_{c} USING (episode_index)")
    return ", ".join(views), " ".join(columns)


_VIEWS, _JOINS = _gate_groups()


@query("gate_episode_metrics", f"""WITH {VF}, {_HAND}, {_VIEWS}, n AS (SELECT episode_index, count(*) AS parquet_rows, bool_and(len(list_filter(state, lambda x: NOT isfinite(x))) = 0) AS finite_state, bool_and(len(list_filter(action, lambda x: NOT isfinite(x))) = 0) AS finite_action FROM vf GROUP BY 1)
 SELECT * FROM n {_JOINS} JOIN hm USING (episode_index)""")
def gate_episode_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Every metric that the gate's rules read of frames, over all groups."""
    from motionloom.operators.gate import GROUPS, episode_metrics
    from motionloom.operators.hand import METRICS

    p95 = [f"{g}_{n}_l2_p95" for g in GROUPS for n in ("velocity", "acceleration", "jerk")] + ["state_step_l2_p95", "action_step_l2_p95", *METRICS]
    return episode_metrics(vector_frames(spark, d), FPS).select(E, "parquet_rows", "finite_state", "finite_action", *[r6(c).alias(c) for c in p95])
