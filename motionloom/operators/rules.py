"""Issue rules as data, scores, and reports made of them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR_COST, WARNING_COST = 35, 8


@dataclass(frozen=True)
class Rule:
    code: str
    severity: str
    holds: Column
    metric: str = ""
    value: Column | None = None
    message: str = ""


def issues(table: DataFrame, rules: Sequence[Rule], episode: str = "episode_index", date: str = "source_date") -> DataFrame:
    """One row per rule that holds on a row of table: no join, one pass."""
    made = [F.when(r.holds, F.struct(F.lit(r.severity).alias("severity"), F.lit(r.code).alias("code"), F.lit(r.message or r.code.replace("_", " ")).alias("message"), F.lit(r.metric).alias("metric"), (r.value if r.value is not None else F.lit(None)).cast("double").alias("value"), F.lit(i).alias("rule_no"))) for i, r in enumerate(rules)]
    return table.select(episode, date, F.explode(F.array_compact(F.array(*made))).alias("i")).select(episode, date, "i.*")


def scores(episodes: DataFrame, issue_rows: DataFrame, episode: str = "episode_index", keep: int = 6) -> DataFrame:
    """Adds error_count, warning_count, issue_count, quality_score (100 less 35 an error and 8 a warning, 0 at least) and
    issue_summary (the first six codes in rule order)."""
    codes = F.array_sort(F.collect_list(F.struct("rule_no", "code")))
    own = issue_rows.groupBy(F.col(episode).alias("__e")).agg(F.count_if(F.col("severity") == "error").alias("ec"), F.count_if(F.col("severity") == "warning").alias("wc"), F.array_join(F.transform(F.slice(codes, 1, keep), lambda c: c["code"]), ", ").alias("sm"))
    joined = episodes.join(own, F.col(episode) == F.col("__e"), "left")
    err, warn = F.coalesce("ec", F.lit(0)), F.coalesce("wc", F.lit(0))
    return joined.select(*episodes.columns, err.alias("error_count"), warn.alias("warning_count"), (err + warn).alias("issue_count"), F.greatest(F.lit(0), 100 - ERROR_COST * err - WARNING_COST * warn).cast("double").alias("quality_score"), F.coalesce("sm", F.lit("")).alias("issue_summary"))


def worst(scored: DataFrame, k: int = 30, episode: str = "episode_index") -> DataFrame:
    return scored.orderBy("quality_score", F.desc("issue_count"), episode).limit(k)


def ordered(issue_rows: DataFrame, episode: str = "episode_index", date: str = "source_date") -> DataFrame:
    """The order of issue reports."""
    return issue_rows.orderBy(date, episode, "severity", "code")


def top_by(table: DataFrame, metric: str, k: int = 8, tie: str = "episode_index") -> DataFrame:
    """The k rows with the largest metric; rows without it take no part."""
    return table.where(F.col(metric).isNotNull() & ~F.isnan(F.col(metric).cast("double"))).orderBy(F.desc(metric), tie).limit(k)


def capped(issue_rows: DataFrame, group: str, order: Sequence[str], most: int = 50) -> DataFrame:
    """The first issues of each group, and one row `truncated` with the number of the others where there are any."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    rows = issue_rows.withColumn("__p", place)
    over = rows.where(F.col("__p") > most).groupBy(group).agg(F.count(F.lit(1)).cast("double").alias("value")).select(group, F.lit("truncated").alias("code"), F.col("value"))
    return rows.where(F.col("__p") <= most).drop("__p").select(group, "code", "value").unionByName(over)


def batch_status(found: DataFrame, group: str) -> DataFrame:
    """fail with any error, pass_with_warnings with any warning, else pass."""
    return found.groupBy(group).agg(F.max(F.col("severity") == "error").alias("e"), F.max(F.col("severity") == "warning").alias("w")).select(group, F.when(F.col("e"), "fail").when(F.col("w"), "pass_with_warnings").otherwise("pass").alias("status"))


def json_safe(table: DataFrame) -> DataFrame:
    """NaN and infinities of double columns as null, for JSON."""
    from motionloom.functions.vectors import finite

    return table.select(*[finite(F.col(f"`{f.name}`")).alias(f.name) if f.dataType.typeName() in ("double", "float") else F.col(f"`{f.name}`") for f in table.schema])
