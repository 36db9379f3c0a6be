"""Queries on structure, text, payloads, dates, manifests and incremental runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionloom.functions import text as X
from motionloom.functions.vectors import r6
from motionloom.operators import clips as C
from motionloom.operators import incremental as I
from motionloom.operators import sequences as Q
from motionloom.operators import stats as A
from motionloom.operators.quantiles import summaries
from motionloom.plans.registry import query
from motionloom.sources import discovery
from motionloom.plans.views import SFR, VF, read, scalar_frames, vector_frames


@query("global_index_offsets", """WITH l AS (SELECT conv_id, count(*) AS length FROM conversations GROUP BY 1)
 SELECT conv_id, length, CAST(coalesce(sum(length) OVER (ORDER BY conv_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM l""")
def global_index_offsets(spark: SparkSession, d: str) -> DataFrame:
    return Q.offsets(read(spark, d, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("length")), "conv_id", "length")


@query("frame_contiguity", "SELECT conv_id, count(*) AS n, min(turn) = 0 AND max(turn) = count(*) - 1 AND count(DISTINCT turn) = count(*) AS contiguous FROM conversations GROUP BY 1")
def frame_contiguity(spark: SparkSession, d: str) -> DataFrame:
    return Q.contiguity(read(spark, d, "conversations"), "conv_id", "turn")


@query("stored_order_contiguity", f"""WITH {SFR}, x AS (SELECT episode_index, frame_index = row_number() OVER (PARTITION BY episode_index ORDER BY event_id) - 1 AS ok FROM sfr)
 SELECT episode_index, count(*) AS n, bool_and(ok) AS contiguous FROM x GROUP BY 1""")
def stored_order_contiguity(spark: SparkSession, d: str) -> DataFrame:
    return Q.contiguity(scalar_frames(spark, d), "episode_index", "frame_index", "event_id")


@query("vector_fingerprints", f"""WITH {VF}, h AS (SELECT episode_index, frame_index, sha256(array_to_string(list_transform(action, lambda x: coalesce(CAST(CAST(floor(CASE WHEN isfinite(x) THEN x END * 1e6 + 0.5) AS BIGINT) AS VARCHAR), 'null')), ',')) AS h FROM vf),
 c AS (SELECT episode_index, frame_index // 4096 AS c, count(*) AS n, sha256(string_agg(h, ',' ORDER BY frame_index, h)) AS h FROM h GROUP BY 1, 2)
 SELECT episode_index, CAST(sum(n) AS BIGINT) AS frames, sha256(string_agg(h, ',' ORDER BY c, h)) AS fingerprint FROM c GROUP BY 1""")
def vector_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return Q.vector_fingerprint(vector_frames(spark, d), "action")


@query("done_flag_check", """WITH x AS (SELECT conv_id, (role = 'assistant') IS NOT DISTINCT FROM (lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) IS NULL) AS ok FROM conversations) SELECT conv_id, bool_and(ok) AS done_ok FROM x GROUP BY 1""")
def done_flag_check(spark: SparkSession, d: str) -> DataFrame:
    return Q.done_only_last(read(spark, d, "conversations"), "conv_id", "turn", F.col("role") == "assistant")


@query("duplicate_index", "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_index(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


@query("referential_gaps", """SELECT 'order_without_lines' AS gap, o_orderkey AS id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
 UNION ALL SELECT 'label_without_document', doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)
 UNION ALL SELECT DISTINCT 'line_without_order', l_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def referential_gaps(spark: SparkSession, d: str) -> DataFrame:
    o, li = read(spark, d, "orders").select(F.col("o_orderkey").alias("id")), read(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"))
    lab, doc = read(spark, d, "labels").select(F.col("doc_id").alias("id")), read(spark, d, "documents").select(F.col("doc_id").alias("id"))
    name = lambda t, n: t.select(F.lit(n).alias("gap"), "id")
    return name(o.join(li, "id", "left_anti"), "order_without_lines").unionByName(name(lab.join(doc, "id", "left_anti"), "label_without_document")).unionByName(name(li.join(o, "id", "left_anti").distinct(), "line_without_order"))


@query("declared_totals", """WITH l AS (SELECT l_orderkey AS k, count(*) AS n, max(l_linenumber) - min(l_linenumber) + 1 AS span, count(DISTINCT l_linenumber) AS kinds FROM lineitem GROUP BY 1)
 SELECT o_orderstatus, count(*) AS orders, CAST(coalesce(sum(n), 0) AS BIGINT) AS lines, CAST(count_if(n <> kinds) AS BIGINT) AS with_duplicates, CAST(count_if(span <> n) AS BIGINT) AS not_contiguous FROM orders LEFT JOIN l ON o_orderkey = k GROUP BY 1""")
def declared_totals(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.count(F.lit(1)).alias("n"), (F.max("l_linenumber") - F.min("l_linenumber") + 1).alias("span"), F.count_distinct("l_linenumber").alias("kinds"))
    return read(spark, d, "orders").join(li, F.col("o_orderkey") == F.col("k"), "left").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"), F.coalesce(F.sum("n"), F.lit(0)).alias("lines"), F.count_if(F.col("n") != F.col("kinds")).alias("with_duplicates"), F.count_if(F.col("span") != F.col("n")).alias("not_contiguous"))


@query("source_date_extract", """WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'episode_' || strftime(o_orderdate, '%Y%m%d') || 'T09Z' WHEN o_orderkey % 3 = 1 THEN 'day/' || strftime(o_orderdate, '%Y-%m-%d') || '/x' ELSE 'none' END AS path FROM orders),
 y AS (SELECT *, nullif(regexp_extract(path, '(20\\d{6})', 1), '') AS c, nullif(regexp_extract(path, '(\\d{4}-\\d{2}-\\d{2})', 1), '') AS i FROM x)
 SELECT o_orderkey, coalesce(substr(c, 1, 4) || '-' || substr(c, 5, 2) || '-' || substr(c, 7, 2), i, 'unknown') AS source_date FROM y""")
def source_date_extract(spark: SparkSession, d: str) -> DataFrame:
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    path = F.when(key % 3 == 0, F.concat(F.lit("episode_"), F.date_format(day, "yyyyMMdd"), F.lit("T09Z"))).when(key % 3 == 1, F.concat(F.lit("day/"), F.date_format(day, "yyyy-MM-dd"), F.lit("/x"))).otherwise("none")
    return read(spark, d, "orders").select("o_orderkey", X.source_date([path]).alias("source_date"))


@query("frame_rate_parse", """WITH x AS (SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN (p_size * 1000) || '/1001' WHEN p_partkey % 4 = 1 THEN p_size || '' WHEN p_partkey % 4 = 2 THEN p_size || '/0' ELSE p_name END AS rate FROM part)
 SELECT p_partkey, round(CASE WHEN rate LIKE '%/%' THEN TRY_CAST(split_part(rate, '/', 1) AS DOUBLE) / nullif(TRY_CAST(split_part(rate, '/', 2) AS DOUBLE), 0) ELSE TRY_CAST(rate AS DOUBLE) END, 6) AS fps FROM x""")
def frame_rate_parse(spark: SparkSession, d: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    rate = F.when(key % 4 == 0, F.concat((size * 1000).cast("string"), F.lit("/1001"))).when(key % 4 == 1, size.cast("string")).when(key % 4 == 2, F.concat(size.cast("string"), F.lit("/0"))).otherwise(F.col("p_name"))
    return read(spark, d, "part").select("p_partkey", F.round(X.frame_rate(rate), 6).alias("fps"))


@query("path_sanitise", """SELECT page_id, coalesce(nullif(regexp_replace(regexp_replace(split_part(rtrim(url, '/'), '/', -1), '[^A-Za-z0-9_.-]+', '_', 'g'), '^[._-]+|[._-]+$', '', 'g'), ''), 'unnamed') AS component FROM pages""")
def path_sanitise(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "pages").select("page_id", X.path_component(F.col("url")).alias("component"))


@query("json_props_extract", "SELECT event_type, count(CAST(props->>'k' AS BIGINT)) AS n, CAST(sum(CAST(props->>'k' AS BIGINT)) AS BIGINT) AS total, max(CAST(props->>'k' AS BIGINT)) AS most FROM events GROUP BY 1")
def json_props_extract(spark: SparkSession, d: str) -> DataFrame:
    k = F.from_json("props", "k bigint")["k"]
    return read(spark, d, "events").groupBy("event_type").agg(F.count(k).alias("n"), F.sum(k).alias("total"), F.max(k).alias("most"))


@query("mode_smallest", """WITH c AS (SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY n DESC, c_nationkey) AS k FROM c)
 SELECT c_mktsegment, c_nationkey AS most_common FROM r WHERE k = 1""")
def mode_smallest(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "customer").groupBy("c_mktsegment").agg(F.mode("c_nationkey", True).alias("most_common"))


@query("fingerprint", """SELECT c_custkey, sha256('{"name":"' || c_name || '","nation":' || c_nationkey || ',"version":1}') AS fingerprint FROM customer""")
def fingerprint(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "customer").select("c_custkey", X.fingerprint(version=F.lit(1), name=F.col("c_name"), nation=F.col("c_nationkey")).alias("fingerprint"))


@query("date_summary", """WITH x AS (SELECT strftime(o_orderdate, '%Y-%m') AS source_date, o_totalprice AS p, o_orderstatus = 'F' AS bad FROM orders)
 SELECT source_date, count(*) AS episodes, round(sum(p), 4) AS total, round(avg(p), 6) AS mean, CAST(count_if(bad) AS BIGINT) AS bad, round(CAST(count_if(bad) AS BIGINT) / count(*)::DOUBLE, 6) AS bad_ratio FROM x GROUP BY 1""")
def date_summary(spark: SparkSession, d: str) -> DataFrame:
    bad = F.col("o_orderstatus") == "F"
    o = read(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("source_date"))
    return o.agg(F.count(F.lit(1)).alias("episodes"), F.round(F.sum("o_totalprice"), 4).alias("total"), r6(F.avg("o_totalprice")).alias("mean"), F.count_if(bad).alias("bad"), r6(F.count_if(bad) / F.count(F.lit(1))).alias("bad_ratio"))


@query("date_metric_matrix", """WITH x AS (SELECT strftime(o_orderdate, '%Y') AS source_date, o_orderpriority AS metric, o_totalprice AS p FROM orders)
 SELECT source_date, metric, round(avg(p), 6) AS mean, round(quantile_cont(p, 0.5), 6) AS p50, round(quantile_cont(p, 0.95), 6) AS p95, round(max(p), 6) AS max FROM x GROUP BY 1, 2""")
def date_metric_matrix(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy").alias("source_date"), F.col("o_orderpriority").alias("metric"), "o_totalprice")
    out = summaries(o, ["source_date", "metric"], F.col("o_totalprice"), "x", ("mean", "p50", "p95", "max"))
    return out.select("source_date", "metric", *[r6(f"x_{k}").alias(k) for k in ("mean", "p50", "p95", "max")])


@query("weighted_summary", """WITH c AS (SELECT o_custkey, count(*) AS frames, avg(o_totalprice) AS m FROM orders GROUP BY 1)
 SELECT c_mktsegment AS segment, round(sum(m * frames) / greatest(sum(frames), 1), 4) AS weighted, round(max(m), 6) AS most, CAST(sum(frames) AS BIGINT) AS frames FROM c JOIN customer ON c_custkey = o_custkey GROUP BY 1""")
def weighted_summary(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("frames"), F.avg("o_totalprice").alias("m"))
    return c.join(read(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey")).groupBy(F.col("c_mktsegment").alias("segment")).agg(F.round(A.weighted_mean("m", "frames"), 4).alias("weighted"), r6(F.max("m")).alias("most"), F.sum("frames").alias("frames"))


@query("histogram_bins", "SELECT CAST(least(floor(value / 5), 19) AS INTEGER) AS bin, count(*) AS count FROM events WHERE value BETWEEN 0 AND 100 GROUP BY 1")
def histogram_bins(spark: SparkSession, d: str) -> DataFrame:
    return A.histogram(read(spark, d, "events"), "value", 0, 100, 20)


_RUNS = """now AS (SELECT o_orderkey AS k, o_orderstatus || ':' || o_custkey AS f FROM orders), old AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN 'stale' ELSE o_orderstatus || ':' || o_custkey END AS f FROM orders WHERE o_orderkey % 5 <> 0)"""


@query("incremental_reuse", f"""WITH {_RUNS} SELECT CASE WHEN EXISTS (SELECT 1 FROM old WHERE old.k = now.k AND old.f = now.f) THEN 'reused' ELSE 'computed' END AS state, count(*) AS episodes FROM now GROUP BY 1""")
def incremental_reuse(spark: SparkSession, d: str) -> DataFrame:
    f = F.concat_ws(":", "o_orderstatus", F.col("o_custkey").cast("string"))
    now = read(spark, d, "orders").select(F.col("o_orderkey").alias("k"), f.alias("f"))
    old = now.where("k % 5 <> 0").withColumn("f", F.when(F.col("k") % 7 == 0, "stale").otherwise(F.col("f")))
    reused, todo = I.reusable(now, old, "k", "f").withColumn("state", F.lit("reused")), I.to_do(now, old, "k", "f").withColumn("state", F.lit("computed"))
    return I.merge_cached(reused, todo).groupBy("state").agg(F.count(F.lit(1)).alias("episodes"))


@query("latest_processed", "SELECT user_id AS episode_index, arg_max(event_type, event_id) AS status, max(event_id) AS line FROM events GROUP BY 1")
def latest_processed(spark: SparkSession, d: str) -> DataFrame:
    log = read(spark, d, "events").select(F.col("user_id").alias("episode_index"), F.col("event_type").alias("status"), F.col("event_id").alias("line"))
    return I.latest(log, "episode_index", "line")


@query("manifest_merge", """WITH o AS (SELECT c_mktsegment AS item_type, c_name AS name, 'old' AS version FROM customer), n AS (SELECT c_mktsegment AS item_type, c_name AS name, 'new' AS version FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_custkey % 2 = 0)
 SELECT * FROM o WHERE item_type NOT IN (SELECT item_type FROM n) UNION ALL SELECT * FROM n""")
def manifest_merge(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "customer")
    old = c.select(F.col("c_mktsegment").alias("item_type"), F.col("c_name").alias("name"), F.lit("old").alias("version"))
    new = c.where("c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_custkey % 2 = 0").select(F.col("c_mktsegment").alias("item_type"), F.col("c_name").alias("name"), F.lit("new").alias("version"))
    return I.merge_manifest(old, new)


@query("date_view", """WITH e AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m') END AS source_date, o_custkey AS n FROM orders)
 SELECT source_date, count(*) AS total_episodes, CAST(sum(n) AS BIGINT) AS total_frames, count(DISTINCT k // 1000) AS total_chunks, min(k) AS first_episode, max(k) AS last_episode FROM e WHERE source_date IS NOT NULL GROUP BY 1""")
def date_view(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("o_orderkey")
    e = read(spark, d, "orders").select(key.alias("episode_index"), F.when(key % 11 != 0, F.date_format("o_orderdate", "yyyy-MM")).alias("source_date"), F.col("o_custkey").alias("length"))
    return I.date_view(e)


@query("data_paths", "SELECT o_orderkey AS episode_index, printf('data/chunk-%03d/episode_%06d.parquet', o_orderkey // 1000, o_orderkey) AS path FROM orders")
def data_paths(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").select(F.col("o_orderkey").alias("episode_index"), X.data_path(F.col("o_orderkey")).alias("path"))


@query("task_alignment", """WITH t AS (SELECT DISTINCT coalesce(nullif(trim(c_mktsegment), ''), 'teleop') AS task FROM customer) SELECT CAST(row_number() OVER (ORDER BY task) - 1 AS INTEGER) AS task_index, task, (SELECT count(*) FROM customer WHERE c_mktsegment = task) AS episodes FROM t""")
def task_alignment(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    c = read(spark, d, "customer").groupBy(X.task_text(F.col("c_mktsegment")).alias("task")).agg(F.count(F.lit(1)).alias("episodes"))
    return c.select((F.row_number().over(Window.orderBy("task")) - 1).alias("task_index"), "task", "episodes")


@query("clip_rows", f"""WITH {SFR}, n AS (SELECT episode_index, count(*) AS n FROM sfr GROUP BY 1), w AS (SELECT episode_index AS source_episode, 1 AS a, least(n - 1, 5) AS z FROM n WHERE n >= 2 UNION ALL SELECT episode_index, 0, 0 FROM n),
 o AS (SELECT *, row_number() OVER (ORDER BY source_episode, a, z) - 1 + (SELECT count(*) FROM n) AS e, coalesce(sum(z - a + 1) OVER (ORDER BY source_episode, a, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (SELECT count(*) FROM sfr) AS b FROM w)
 SELECT e AS episode_index, frame_index - a AS frame_index, CAST(b + frame_index - a AS BIGINT) AS index, round((frame_index - a) / 10.0, 6) AS timestamp, frame_index = z AS done, round(value, 6) AS value FROM o JOIN sfr ON sfr.episode_index = o.source_episode AND frame_index BETWEEN a AND z""")
def clip_rows(spark: SparkSession, d: str) -> DataFrame:
    """Two clips of every episode, as appended after all episodes: frames 1 to 5, and frame 0."""
    frames = scalar_frames(spark, d)
    n = frames.groupBy("episode_index").agg(F.count(F.lit(1)).alias("n"))
    first = n.where("n >= 2").select(F.col("episode_index").alias("source_episode"), F.lit(1).cast("bigint").alias("start_frame"), F.least(F.col("n") - 1, F.lit(5)).alias("end_frame"))
    second = n.select(F.col("episode_index").alias("source_episode"), F.lit(0).cast("bigint").alias("start_frame"), F.lit(0).cast("bigint").alias("end_frame"))
    episodes, rows = n.agg(F.count(F.lit(1)), F.sum("n")).first()
    out = C.clipped(frames, C.allocated(first.union(second), episodes, rows), 10.0)
    return out.select("episode_index", "frame_index", "index", r6("timestamp").alias("timestamp"), "done", r6("value").alias("value"))


@query("discovered_paths", """SELECT c_custkey AS episode_index, CASE WHEN c_custkey % 3 = 0 THEN 'given/' || c_custkey || '.parquet' WHEN c_custkey % 7 = 0 THEN 'made/' || c_custkey || '.parquet' ELSE printf('data/chunk-%03d/episode_%06d.parquet', c_custkey // 100, c_custkey) END AS data_path,
 CASE WHEN c_custkey % 5 = 0 THEN 'v/' || c_custkey || '.mp4' ELSE printf('videos/ego/%06d.mp4', c_custkey) END AS video_path, CASE WHEN c_custkey % 2 = 0 THEN 'unknown' ELSE '2024-01-' || lpad(CAST(1 + c_nationkey AS VARCHAR), 2, '0') END AS source_date FROM customer""")
def discovered_paths(spark: SparkSession, d: str) -> DataFrame:
    """Paths and dates of rows with own, nested, absent and null keys."""
    c = read(spark, d, "customer")
    key = F.col("c_custkey")
    text = lambda *p: F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in p])
    day = F.concat(F.lit("ep_202401"), F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0"), F.lit("_x"))
    nested = F.concat_ws(",", text('"raw_episode_id":"', day, '"'), F.when(key % 3 == 0, text('"data_path":"given/', key, '.parquet"')), F.when(key % 5 == 0, text('"video_paths":{"ego":"v/', key, '.mp4"}')))
    row = F.concat_ws(",", text('"episode_index":', key), F.when(key % 2 == 0, F.lit('"raw_episode_id":null')), F.when(key % 7 == 0, text('"output_data_path":"made/', key, '.parquet"')), text('"teleop_stack_metadata":{', nested, "}"))
    info = {"chunks_size": 100, "video_path": "videos/{video_key}/{episode_index:06d}.mp4", "features": {"ego": {"dtype": "video"}}}
    files = spark.createDataFrame([], "file string, size bigint, modified timestamp")
    out = discovery.episodes_with_files(c.select(text("{", row, "}").alias("value")), files, info)
    return out.select("episode_index", "data_path", F.col("videos")[0]["path"].alias("video_path"), "source_date")
