"""Queries on inspection and repair of positions, on names and labels, and on small relational steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionloom.functions import text as T
from motionloom.functions.vectors import r6
from motionloom.operators import incremental as I
from motionloom.operators import repair as R
from motionloom.operators import rules
from motionloom.operators.mapping import signed_permutations
from motionloom.plans.registry import query
from motionloom.plans.views import EPISODES, VF, read, step_metrics, vector_frames

E = "episode_index"


def _positions(spark: SparkSession, d: str) -> DataFrame:
    return vector_frames(spark, d).select(E, "frame_index", F.slice("state", 8, 3).alias("s"), F.slice("action", 1, 3).alias("a"))


_CANDIDATES = ", ".join(f"({n}, [{', '.join(str(i + 1) for i in p)}], [{', '.join(map(str, s))}], '{''.join(map(str, p))}', '{''.join('+' if x > 0 else '-' for x in s)}')" for n, (p, s) in enumerate(signed_permutations()))


def _rmse_sql(b: str, offset: bool) -> str:
    """b: the three SQL terms of the other side, separated by |."""
    terms = [f"{'var_pop' if offset else 'avg'}({x if offset else f'({x}) * ({x})'})" for x in (f"st[{i + 1}] - {y}" for i, y in enumerate(b.split("|")))]
    return f"sqrt(({' + '.join(terms)}) / 3)"


_INSPECTED = f"""{VF}, c(candidate, p, s, perm, signs) AS (VALUES {_CANDIDATES}), x AS (SELECT episode_index, frame_index, state[8:10] AS st, action[1:3] AS ac FROM vf),
 d AS (SELECT x.episode_index, c.candidate, any_value(perm) AS perm, any_value(signs) AS signs, sqrt((var_pop(st[1] - s[1] * ac[p[1]]) + var_pop(st[2] - s[2] * ac[p[2]]) + var_pop(st[3] - s[3] * ac[p[3]])) / 3) AS rmse FROM x, c GROUP BY 1, 2),
 k AS (SELECT *, row_number() OVER (PARTITION BY episode_index ORDER BY round(rmse, 9), candidate) AS k FROM d), best AS (SELECT * FROM k WHERE k = 1),
 e AS (SELECT episode_index, count(*) AS frames, {_rmse_sql('ac[1]|ac[2]|ac[3]', False)} AS direct_rmse, {_rmse_sql('ac[1]|ac[2]|ac[3]', True)} AS offset_rmse, {_rmse_sql('ac[3]|ac[1]|ac[2]', False)} AS expected_rmse, {_rmse_sql('ac[3]|ac[1]|ac[2]', True)} AS expected_offset_rmse,
  CASE WHEN count(*) >= 2 THEN list_avg([corr(st[1], ac[3]), corr(st[2], ac[1]), corr(st[3], ac[2])]) END AS corr_diag_mean FROM x GROUP BY 1),
 i AS (SELECT e.*, best.perm AS best_perm, best.signs AS best_signs, best.rmse AS best_rmse, best.perm = '201' AND best.signs = '+++' AS best_is_expected, best.perm = '012' AND best.signs = '+++' AS best_is_identity FROM e JOIN best USING (episode_index))"""


@query("position_inspection", f"""WITH {_INSPECTED} SELECT episode_index, frames, round(direct_rmse, 6) AS direct_rmse, round(expected_rmse, 6) AS expected_rmse, round(expected_offset_rmse, 6) AS expected_offset_rmse,
 round(corr_diag_mean, 6) AS corr_diag_mean, best_perm, best_signs, round(best_rmse, 6) AS best_rmse, best_is_expected, best_is_identity, coalesce(expected_offset_rmse > {R.OFFSET_RMSE}, true) AS refused FROM i""")
def position_inspection(spark: SparkSession, d: str) -> DataFrame:
    """The inspection table, and which episodes the gate refuses."""
    seen = R.inspect_positions(_positions(spark, d), "s", "a")
    bad = R.refused(seen).select(F.col(E).alias("bad"))
    joined = seen.join(bad, F.col(E) == F.col("bad"), "left")
    number = lambda c: r6(c).alias(c)
    return joined.select(E, "frames", number("direct_rmse"), number("expected_rmse"), number("expected_offset_rmse"), number("corr_diag_mean"), "best_perm", "best_signs", number("best_rmse"), "best_is_expected", "best_is_identity", F.col("bad").isNotNull().alias("refused"))


_MEANS = ("direct_rmse", "expected_rmse", "expected_offset_rmse", "best_rmse", "corr_diag_mean")


@query("mapping_summary", f"""WITH {_INSPECTED}, g AS (SELECT *, episode_index % 3 AS dataset FROM i),
 m AS (SELECT dataset, best_perm, row_number() OVER (PARTITION BY dataset ORDER BY count(*) DESC, best_perm) AS k FROM g GROUP BY 1, 2), n AS (SELECT dataset, best_signs, row_number() OVER (PARTITION BY dataset ORDER BY count(*) DESC, best_signs) AS k FROM g GROUP BY 1, 2),
 a AS (SELECT dataset, count(*) AS episodes, round(avg(CASE WHEN best_is_expected THEN 1.0::DOUBLE ELSE 0 END), 6) AS expected_ratio, round(avg(CASE WHEN best_is_identity THEN 1.0::DOUBLE ELSE 0 END), 6) AS identity_ratio,
  {', '.join(f'round(avg({c}), 6) AS {c if c == "corr_diag_mean" else c + "_mean"}' for c in _MEANS)}, round(max(best_rmse), 6) AS best_rmse_max FROM g GROUP BY 1)
 SELECT a.*, m.best_perm, n.best_signs FROM a JOIN m ON m.dataset = a.dataset AND m.k = 1 JOIN n ON n.dataset = a.dataset AND n.k = 1""")
def mapping_summary(spark: SparkSession, d: str) -> DataFrame:
    seen = R.inspect_positions(_positions(spark, d), "s", "a").withColumn("dataset", F.col(E) % 3)
    out = R.mapping_summary(seen, "dataset")
    return out.select(*[r6(c).alias(c) if kind == "double" else c for c, kind in out.dtypes])


@query("position_repair", f"WITH {VF} SELECT episode_index, frame_index, round(action[3], 6) AS x, round(action[1], 6) AS y, round(action[2], 6) AS z, CAST(len(action) AS INTEGER) AS width, round(list_sum(action[4:19]), 6) AS rest FROM vf")
def position_repair(spark: SparkSession, d: str) -> DataFrame:
    """The actions after the repair; the gate is open, since these tables are no recordings."""
    frames = vector_frames(spark, d)
    fixed = R.repair_positions(frames, R.inspect_positions(_positions(spark, d), "s", "a"), "action", limit=float("inf"))
    rest = F.aggregate(F.slice("action", 4, 16), F.lit(0.0), lambda t, x: t + x)
    return fixed.select(E, "frame_index", *[r6(F.col("action")[k]).alias(c) for k, c in enumerate("xyz")], F.size("action").alias("width"), r6(rest).alias("rest"))


@query("alignment_diagnosis", f"""WITH {_INSPECTED}, l AS (SELECT CAST(unnest(range(-20, 21)) AS INTEGER) AS lag),
 q AS (SELECT a.episode_index, l.lag, count(*) AS n, sqrt(sum(list_distance(a.ac, b.st) ** 2) / (3 * count(*))) AS r FROM x a CROSS JOIN l JOIN x b ON a.episode_index = b.episode_index AND b.frame_index = a.frame_index + l.lag GROUP BY 1, 2),
 g AS (SELECT episode_index, arg_min(lag, (round(r, 9), lag)) AS best_lag, min(r) AS best_lag_rmse FROM q WHERE n >= 2 GROUP BY 1)
 SELECT i.episode_index, frames, round(direct_rmse, 6) AS direct_rmse, round(offset_rmse, 6) AS offset_rmse, best_lag, round(best_lag_rmse, 6) AS best_lag_rmse, best_perm, best_signs, round(best_rmse, 6) AS best_perm_rmse,
 round(best_rmse / nullif(direct_rmse, 0), 6) AS direct_ratio, round(best_rmse / nullif(offset_rmse, 0), 6) AS offset_ratio, best_is_identity AS is_identity, coalesce(NOT best_is_identity AND best_rmse / nullif(direct_rmse, 0) <= 0.6, false) AS suspected FROM i LEFT JOIN g USING (episode_index)""")
def alignment_diagnosis(spark: SparkSession, d: str) -> DataFrame:
    out = R.alignment_diagnosis(_positions(spark, d), "s", "a")
    return out.select(*[r6(c).alias(c) if kind == "double" else c for c, kind in out.dtypes])


_PATH = "concat('/rigs/', CASE c_nationkey % 3 WHEN 0 THEN 'Nero' WHEN 1 THEN 'rokae' ELSE 'other' END, '/mission', c_nationkey, CASE WHEN c_custkey % 2 = 0 THEN '/sets_by_date/' ELSE '/sets/' END, lower(c_mktsegment), '/', c_custkey)"


@query("routing_labels", """SELECT c_custkey AS dataset, CASE c_nationkey % 3 WHEN 0 THEN 'nero' WHEN 1 THEN 'rokae' ELSE CASE WHEN c_custkey % 5 = 0 THEN 'rokae' ELSE 'unknown_hardware' END END AS hardware, 'mission' || c_nationkey AS mission,
 CASE WHEN c_custkey % 2 = 0 THEN 'sets_by_date_' ELSE '' END || lower(c_mktsegment) || '_' || c_custkey AS label FROM customer""")
def routing_labels(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "customer").withColumn("path", F.expr(_PATH)).withColumn("kind", F.when(F.col("c_custkey") % 5 == 0, "XMate3"))
    routed = c.withColumn("r", T.routing(F.col("path"), F.coalesce("kind", F.lit(""))))
    return routed.select(F.col("c_custkey").alias("dataset"), "r.hardware", "r.mission", T.output_label(F.col("path")).alias("label"))


@query("action_dim_means", f"""WITH {VF}, x AS (SELECT generate_subscripts(action, 1) AS k, unnest(action) AS v FROM vf)
 SELECT ([{', '.join(repr(n) for n in T.ACTION_NAMES)}])[k] AS name, count(*) AS n, round(avg(v), 6) AS mean FROM x GROUP BY 1""")
def action_dim_means(spark: SparkSession, d: str) -> DataFrame:
    x = vector_frames(spark, d).select(F.posexplode("action").alias("dim", "v"))
    return x.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("v")).alias("mean")).select(T.action_name(F.col("dim")).alias("name"), "n", "mean")


@query("shown_vectors", f"""WITH {VF} SELECT episode_index, frame_index, '[' || array_to_string(list_transform(list_transform(action[1:6], lambda x: CAST(round(x * 8) AS BIGINT) / 8.0::DOUBLE), lambda x: printf('%.4f', x)), ', ') || ', ...] shape=(' || len(action) || ',)' AS shown FROM vf""")
def shown_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Components to an eighth, which both sides write alike."""
    v = vector_frames(spark, d).withColumn("action", F.transform("action", lambda x: F.round(x * 8).cast("bigint") / F.lit(8.0)))
    return v.select(E, "frame_index", T.shown_vector(F.col("action")).alias("shown"))


@query("top_episodes_by_metric", f"WITH {EPISODES} SELECT episode_index, mean_price FROM ep WHERE mean_price IS NOT NULL ORDER BY mean_price DESC, episode_index LIMIT 8")
def top_episodes_by_metric(spark: SparkSession, d: str) -> DataFrame:
    return rules.top_by(step_metrics(spark, d), "mean_price").select(E, "mean_price")


@query("first_of_each_host", "SELECT regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host, min(page_id) AS page_id FROM pages WHERE url IS NOT NULL GROUP BY 1")
def first_of_each_host(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "pages").where("url IS NOT NULL").select(F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("host"), "page_id")
    return I.first_of_each(p, "host", "page_id")


@query("manifest_of_view", """WITH m AS (SELECT o_orderkey AS line, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS output_episode_index, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END AS smooth_episode_index, o_custkey + 1 AS episode_index FROM orders)
 SELECT line, coalesce(output_episode_index, smooth_episode_index, episode_index) AS episode FROM m WHERE coalesce(output_episode_index, smooth_episode_index, episode_index) IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def manifest_of_view(spark: SparkSession, d: str) -> DataFrame:
    o, key = read(spark, d, "orders"), F.col("o_custkey")
    m = o.select(F.col("o_orderkey").alias("line"), F.when(F.col("o_orderkey") % 2 == 0, key).alias("output_episode_index"), F.when(F.col("o_orderkey") % 3 == 0, key).alias("smooth_episode_index"), (key + 1).alias(E))
    view = read(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias(E))
    return I.manifest_of(m, view).select("line", F.coalesce("output_episode_index", "smooth_episode_index", E).alias("episode"))


@query("tasks_by_position", """WITH t AS (SELECT n_name AS task, row_number() OVER (ORDER BY n_nationkey) - 1 AS place FROM nation) SELECT c_custkey AS dataset, c_nationkey + 3 AS episode_index, task FROM customer LEFT JOIN t ON place = c_nationkey + 3""")
def tasks_by_position(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    place = (F.row_number().over(Window.orderBy("n_nationkey")) - 1).cast("bigint")  # one row per task
    tasks = read(spark, d, "nation").select(F.col("n_name").alias("task"), place.alias("place"))
    rows = read(spark, d, "customer").select(F.col("c_custkey").alias("dataset"), (F.col("c_nationkey") + 3).alias(E))
    return I.by_position(rows, tasks, "place").select("dataset", E, "task")


_DAY = "1995-06-17"


@query("rows_of_a_date", f"""WITH x AS (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS a, CAST(l_shipdate AS DATE) + CAST(l_linenumber AS INTEGER) AS b, CASE WHEN l_quantity > 25 THEN CAST(l_shipdate AS DATE) - 3 END AS c FROM lineitem)
 SELECT l_orderkey, l_linenumber, coalesce(strftime(c, '%Y-%m-%d') = '{_DAY}', false) AS trimmed FROM x WHERE strftime(a, '%Y-%m-%d') = '{_DAY}' OR strftime(b, '%Y-%m-%d') = '{_DAY}' OR strftime(c, '%Y-%m-%d') = '{_DAY}'""")
def rows_of_a_date(spark: SparkSession, d: str) -> DataFrame:
    day, text = F.to_date("l_shipdate"), lambda x: F.date_format(x, "yyyy-MM-dd")
    dates = {"created": text(day), "smoothed": text(F.date_add(day, F.col("l_linenumber").cast("int"))), "trimmed": F.when(F.col("l_quantity") > 25, text(F.date_sub(day, 3)))}
    rows = read(spark, d, "lineitem").where(T.date_matches(_DAY, "any", dates))
    return rows.select("l_orderkey", "l_linenumber", T.date_matches(_DAY, "trimmed", dates).alias("trimmed"))
