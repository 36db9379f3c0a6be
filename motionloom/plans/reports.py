"""Queries on outliers, issue rules, scores and reports. Episodes are customers, their frames are orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionloom.functions.vectors import r6
from motionloom.operators import rules as U
from motionloom.operators import stats as A
from motionloom.plans.registry import query
from motionloom.plans.views import EPISODES, read, step_metrics

E = "episode_index"


def _mad(metric: str, name: str) -> str:
    return f"""{name}_m AS (SELECT count({metric}) AS n, quantile_cont({metric}, 0.5) AS med, quantile_cont({metric}, 0.95) AS hi, quantile_cont({metric}, 0.05) AS lo FROM ep),
 {name}_d AS (SELECT quantile_cont(abs(ep.{metric} - m.med), 0.5) AS mad FROM ep, {name}_m m)"""


def _high(metric: str, name: str) -> str:
    return f"(SELECT n >= 8 AND CASE WHEN mad <= 1e-12 THEN ep.{metric} > hi AND hi <> med ELSE 0.6745::DOUBLE * (ep.{metric} - med) / mad > 3.5 END FROM {name}_m, {name}_d)"


def _low(metric: str, name: str) -> str:
    return f"(SELECT n >= 8 AND CASE WHEN mad <= 1e-12 THEN ep.{metric} < lo AND lo <> med ELSE -0.6745::DOUBLE * (ep.{metric} - med) / mad > 3.5 END FROM {name}_m, {name}_d)"


@query("robust_outliers_high", f"WITH {EPISODES}, {_mad('max_price', 'a')}, x AS (SELECT episode_index, source_date, {_high('max_price', 'a')} AS outlier FROM ep) SELECT source_date, CAST(count_if(outlier) AS BIGINT) AS outliers, count(*) AS episodes FROM x GROUP BY 1")
def robust_outliers_high(spark: SparkSession, d: str) -> DataFrame:
    return A.robust_mask(step_metrics(spark, d), "max_price").groupBy("source_date").agg(F.count_if("outlier").alias("outliers"), F.count(F.lit(1)).alias("episodes"))


@query("robust_outliers_low", f"WITH {EPISODES}, {_mad('max_price', 'a')}, x AS (SELECT episode_index, source_date, {_low('max_price', 'a')} AS outlier FROM ep) SELECT source_date, CAST(count_if(outlier) AS BIGINT) AS outliers, count(*) AS episodes FROM x GROUP BY 1")
def robust_outliers_low(spark: SparkSession, d: str) -> DataFrame:
    return A.robust_mask(step_metrics(spark, d), "max_price", high=False).groupBy("source_date").agg(F.count_if("outlier").alias("outliers"), F.count(F.lit(1)).alias("episodes"))


METRICS = ("frames", "mean_price", "max_price")


@query("robust_score_topmetric", f"""WITH {EPISODES}, {_mad('frames', 'a')}, {_mad('mean_price', 'b')}, {_mad('max_price', 'c')},
 z AS (SELECT ep.episode_index, abs(0.6745::DOUBLE * (frames - a_m.med) / a_d.mad) AS z0, abs(0.6745::DOUBLE * (mean_price - b_m.med) / b_d.mad) AS z1, abs(0.6745::DOUBLE * (max_price - c_m.med) / c_d.mad) AS z2 FROM ep, a_m, a_d, b_m, b_d, c_m, c_d)
 SELECT episode_index, round(greatest(z0, z1, z2), 6) AS outlier_score, CASE WHEN z0 >= z1 AND z0 >= z2 THEN 'frames' WHEN z1 >= z2 THEN 'mean_price' ELSE 'max_price' END AS top_metric FROM z ORDER BY 2 DESC, 1 LIMIT 12""")
def robust_score_topmetric(spark: SparkSession, d: str) -> DataFrame:
    scored = A.robust_scores(step_metrics(spark, d), METRICS)
    return scored.select(E, r6("outlier_score").alias("outlier_score"), "top_metric").orderBy(F.desc("outlier_score"), E).limit(12)


def _episodes(spark: SparkSession, d: str) -> DataFrame:
    return A.robust_masks(step_metrics(spark, d), [("frames", False, "short"), ("frames", True, "long"), ("max_price", True, "jump"), ("mean_price", False, "cheap")])


def rules() -> list[U.Rule]:
    return [
        U.Rule("frame_count_mismatch", "error", F.col("frames") % 13 == 0, "frames", F.col("frames")),
        U.Rule("short_episode_outlier", "warning", F.col("short"), "frames", F.col("frames")),
        U.Rule("long_episode_outlier", "warning", F.col("long"), "frames", F.col("frames")),
        U.Rule("relative_high_jump", "warning", F.col("jump"), "max_price", F.col("max_price")),
        U.Rule("relative_low_mean", "warning", F.col("cheap"), "mean_price", F.col("mean_price")),
        U.Rule("high_maximum", "warning", F.col("max_price") > 480000, "max_price", F.col("max_price")),
    ]


ISSUES = f"""{EPISODES}, {_mad('frames', 'a')}, {_mad('mean_price', 'b')}, {_mad('max_price', 'c')},
 fl AS (SELECT ep.*, {_low('frames', 'a')} AS short, {_high('frames', 'a')} AS long, {_high('max_price', 'c')} AS jump, {_low('mean_price', 'b')} AS cheap FROM ep),
 iss AS (SELECT episode_index, source_date, 'error' AS severity, 'frame_count_mismatch' AS code, 'frames' AS metric, CAST(frames AS DOUBLE) AS value, 0 AS rule_no FROM fl WHERE frames % 13 = 0
 UNION ALL SELECT episode_index, source_date, 'warning', 'short_episode_outlier', 'frames', frames, 1 FROM fl WHERE short UNION ALL SELECT episode_index, source_date, 'warning', 'long_episode_outlier', 'frames', frames, 2 FROM fl WHERE long
 UNION ALL SELECT episode_index, source_date, 'warning', 'relative_high_jump', 'max_price', max_price, 3 FROM fl WHERE jump UNION ALL SELECT episode_index, source_date, 'warning', 'relative_low_mean', 'mean_price', mean_price, 4 FROM fl WHERE cheap
 UNION ALL SELECT episode_index, source_date, 'warning', 'high_maximum', 'max_price', max_price, 5 FROM fl WHERE max_price > 480000),
 sc AS (SELECT ep.episode_index, ep.source_date, coalesce(e, 0) AS error_count, coalesce(w, 0) AS warning_count, coalesce(e, 0) + coalesce(w, 0) AS issue_count, CAST(greatest(0, 100 - 35 * coalesce(e, 0) - 8 * coalesce(w, 0)) AS DOUBLE) AS quality_score, coalesce(s, '') AS issue_summary
 FROM ep LEFT JOIN (SELECT episode_index, CAST(count_if(severity = 'error') AS BIGINT) AS e, CAST(count_if(severity = 'warning') AS BIGINT) AS w, array_to_string(list(code ORDER BY rule_no)[1:6], ', ') AS s FROM iss GROUP BY 1) x USING (episode_index))"""


@query("issue_rules", f"WITH {ISSUES} SELECT episode_index, source_date, severity, code, metric, round(value, 6) AS value FROM iss")
def issue_rules(spark: SparkSession, d: str) -> DataFrame:
    return U.issues(_episodes(spark, d), rules()).select(E, "source_date", "severity", "code", "metric", F.round("value", 6).alias("value"))


def _scored(spark: SparkSession, d: str) -> DataFrame:
    t = _episodes(spark, d)
    return U.scores(t.select(E, "source_date"), U.issues(t, rules()))


@query("quality_scores", f"WITH {ISSUES} SELECT episode_index, source_date, error_count, warning_count, issue_count, quality_score, issue_summary FROM sc")
def quality_scores(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d)


@query("worst_episodes", f"WITH {ISSUES} SELECT episode_index, source_date, error_count, warning_count, issue_count, quality_score, issue_summary FROM sc ORDER BY quality_score, issue_count DESC, episode_index LIMIT 30")
def worst_episodes(spark: SparkSession, d: str) -> DataFrame:
    return U.worst(_scored(spark, d))


@query("issue_counts", f"WITH {ISSUES} SELECT code, count(*) AS issues FROM iss GROUP BY 1")
def issue_counts(spark: SparkSession, d: str) -> DataFrame:
    return U.issues(_episodes(spark, d), rules()).groupBy("code").agg(F.count(F.lit(1)).alias("issues"))


@query("issue_crosstab", f"""WITH {ISSUES} SELECT source_date, count(*) FILTER (severity = 'error') AS error, count(*) FILTER (severity = 'warning') AS warning, count(*) AS total FROM iss GROUP BY 1 ORDER BY 4 DESC, 1 LIMIT 24""")
def issue_crosstab(spark: SparkSession, d: str) -> DataFrame:
    return A.crosstab(U.issues(_episodes(spark, d), rules()), "source_date", "severity", ["error", "warning"])


@query("batch_status", f"""WITH {ISSUES}, b AS (SELECT ep.episode_index, coalesce(severity, 'none') AS severity FROM ep LEFT JOIN iss USING (episode_index))
 SELECT episode_index, CASE WHEN bool_or(severity = 'error') THEN 'fail' WHEN bool_or(severity = 'warning') THEN 'pass_with_warnings' ELSE 'pass' END AS status FROM b GROUP BY 1""")
def batch_status(spark: SparkSession, d: str) -> DataFrame:
    t = _episodes(spark, d)
    found = U.issues(t, rules()).select(F.col(E).alias("e"), "severity")
    return U.batch_status(t.select(E).join(found, F.col(E) == F.col("e"), "left").select(E, F.coalesce("severity", F.lit("none")).alias("severity")), E)


@query("issues_truncated", f"""WITH {ISSUES}, r AS (SELECT source_date, code, value, row_number() OVER (PARTITION BY source_date ORDER BY code, episode_index) AS p FROM iss)
 SELECT source_date, code, round(value, 6) AS value FROM r WHERE p <= 5 UNION ALL SELECT source_date, 'truncated', CAST(count(*) AS DOUBLE) FROM r WHERE p > 5 GROUP BY 1""")
def issues_truncated(spark: SparkSession, d: str) -> DataFrame:
    out = U.capped(U.issues(_episodes(spark, d), rules()), "source_date", ["code", E], 5)
    return out.select("source_date", "code", F.round("value", 6).alias("value"))


@query("pca_outliers")
def pca_outliers(spark: SparkSession, d: str) -> DataFrame:
    out = A.pca2(step_metrics(spark, d), E, METRICS)
    return out.select(E, r6("pc1").alias("pc1"), r6("pc2").alias("pc2"))


@query("merged_report", """WITH ep AS (SELECT o_custkey AS episode_index, count(*) AS frames FROM orders GROUP BY 1), tm AS (SELECT c_custkey AS k, c_acctbal AS lag FROM customer WHERE c_custkey % 3 <> 0),
 vd AS (SELECT o_custkey AS k, avg(l_quantity) AS quantity, avg(l_discount) AS discount FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)
 SELECT ep.episode_index, ep.frames, round(tm.lag, 6) AS lag_timing, round(vd.quantity, 6) AS quantity_video, round(vd.discount, 6) AS discount_video FROM ep LEFT JOIN tm ON ep.episode_index = tm.k LEFT JOIN vd ON ep.episode_index = vd.k""")
def merged_report(spark: SparkSession, d: str) -> DataFrame:
    """Episodes with their timing row and the means of the numeric columns of their videos, both optional."""
    from motionloom.plans.views import read

    o = read(spark, d, "orders").select(F.col("o_orderkey"), F.col("o_custkey").alias(E))
    ep = o.groupBy(E).agg(F.count(F.lit(1)).alias("frames"))
    tm = read(spark, d, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("k"), r6("c_acctbal").alias("lag_timing"))
    vd = A.mean_of_numeric(read(spark, d, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(E, "l_quantity", "l_discount"), [E])
    vd = vd.select(F.col(E).alias("v"), r6("l_quantity").alias("quantity_video"), r6("l_discount").alias("discount_video"))
    return ep.join(tm, F.col(E) == F.col("k"), "left").join(vd, F.col(E) == F.col("v"), "left").select(E, "frames", "lag_timing", "quantity_video", "discount_video")


@query("nonfinite_counts", """SELECT label AS episode_index, CAST(sum(len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x)))) AS BIGINT) AS nonfinite, min(len(embedding)) = max(len(embedding)) AS even, max(len(embedding)) AS width FROM embeddings GROUP BY 1""")
def nonfinite_counts(spark: SparkSession, d: str) -> DataFrame:
    from motionloom.functions.vectors import finite
    from motionloom.plans.views import read

    v = read(spark, d, "embeddings")
    bad = F.size(F.filter("embedding", lambda x: finite(x).isNull()))
    return v.groupBy(F.col("label").alias(E)).agg(F.sum(bad).alias("nonfinite"), (F.min(F.size("embedding")) == F.max(F.size("embedding"))).alias("even"), F.max(F.size("embedding")).cast("bigint").alias("width"))


@query("correlation_matrix", """WITH x AS (SELECT l_returnflag AS g, l_quantity AS a, l_extendedprice AS b, l_discount AS c FROM lineitem)
 SELECT g, 'a' AS row, 'b' AS col, round(corr(a, b), 6) AS corr FROM x GROUP BY 1 UNION ALL SELECT g, 'a', 'c', round(corr(a, c), 6) FROM x GROUP BY 1 UNION ALL SELECT g, 'b', 'c', round(corr(b, c), 6) FROM x GROUP BY 1""")
def correlation_matrix(spark: SparkSession, d: str) -> DataFrame:
    """All pairs in one aggregation, unfolded afterwards."""
    from motionloom.plans.views import read

    x = read(spark, d, "lineitem").select(F.col("l_returnflag").alias("g"), F.col("l_quantity").alias("a"), F.col("l_extendedprice").alias("b"), F.col("l_discount").alias("c"))
    pairs = [("a", "b"), ("a", "c"), ("b", "c")]
    one = x.groupBy("g").agg(*[A.guarded_corr(F.col(p), F.col(q)).alias(p + q) for p, q in pairs])
    return one.select("g", F.explode(F.array(*[F.struct(F.lit(p).alias("row"), F.lit(q).alias("col"), r6(p + q).alias("corr")) for p, q in pairs])).alias("m")).select("g", "m.*")


@query("video_issues", """WITH n AS (SELECT l_orderkey, count(*) AS length, sum(l_quantity) / 100 AS duration_s FROM lineitem GROUP BY 1),
 v AS (SELECT o_orderkey AS episode_index, strftime(o_orderdate, '%Y-%m-%d') AS source_date, n.l_orderkey IS NOT NULL AS present, length, CASE WHEN o_orderpriority LIKE '1%' THEN 'hevc' ELSE 'h264' END AS codec, CASE WHEN o_orderstatus = 'P' THEN 'yuv422p' ELSE 'yuv420p' END AS pix_fmt,
  duration_s, CASE WHEN o_orderpriority LIKE '5%' AND o_orderstatus = 'O' THEN 'torn' END AS reason, o_totalprice / 5000 AS sharpness FROM orders LEFT JOIN n ON o_orderkey = l_orderkey)
 SELECT episode_index, source_date, code, severity, round(value, 6) AS value FROM (
  SELECT *, 'missing_video' AS code, 'error' AS severity, NULL::DOUBLE AS value FROM v WHERE NOT present
  UNION ALL SELECT *, 'probe_failed', 'error', NULL FROM v WHERE present AND reason IS NOT NULL
  UNION ALL SELECT *, 'browser_unsafe_codec', 'warning', NULL FROM v WHERE present AND reason IS NULL AND NOT (codec = 'h264' AND pix_fmt = 'yuv420p')
  UNION ALL SELECT *, 'duration_mismatch', 'warning', duration_s - length / 10.0 FROM v WHERE present AND abs(duration_s - length / 10.0) > 0.5
  UNION ALL SELECT *, 'low_sharpness', 'warning', sharpness FROM v WHERE present AND sharpness < 20)""")
def video_issues(spark: SparkSession, d: str) -> DataFrame:
    """The rules of videos over orders: lines are frames, their quantity the duration, priority and status the layout."""
    from motionloom.sources import containers

    lines = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("length"), (F.sum("l_quantity") / 100).alias("duration_s"))
    o = read(spark, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    videos = o.select(
        F.col("o_orderkey").alias("episode_index"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("source_date"), F.lit("main").alias("video_key"), F.col("l_orderkey").isNotNull().alias("present"), "length",
        F.when(F.col("o_orderpriority").startswith("1"), "hevc").otherwise("h264").alias("codec"), F.when(F.col("o_orderstatus") == "P", "yuv422p").otherwise("yuv420p").alias("pix_fmt"), "duration_s",
        F.when(F.col("o_orderpriority").startswith("5") & (F.col("o_orderstatus") == "O"), "torn").alias("reason"), (F.col("o_totalprice") / 5000).alias("sharpness"),
    )
    return containers.video_issues(videos, 10.0).select("episode_index", "source_date", "code", "severity", r6("value").alias("value"))
