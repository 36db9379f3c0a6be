"""Row numbers and running totals over a whole table in one order, without one task that sees all rows.

The table is dealt into ranges of the order and cut there, so that a range keeps its rows; each range counts and sums by
itself, and only one row per range meets in one place. Rows equal in all keys stand in any order among themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motionloom.shared import cut

#: The number of a range in what monotonically_increasing_id() gives; below it is the row's place in the range.
_RANGE = 33


def free_name(names: list[str], wanted: str) -> str:
    """wanted, or wanted with as many underscores before it as make it unlike all names; Spark's names don't tell case apart."""
    taken = {n.lower() for n in names}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def in_order(df: DataFrame, *keys: Column, number: str = "number", totals: dict[str, str] | None = None, ranges: int | None = None) -> DataFrame:
    """df with number, 0 for the first row in the order of keys, and for each name and column in totals the sum of that column
    (null counts as 0) over all rows before.

    An empty table stays empty. Columns of df may have any names but those that are added."""
    totals = totals or {}
    spark = df.sparkSession
    names = df.columns
    at, lot = free_name(names, "at"), free_name(names, "lot")
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut(df.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).withColumn(at, F.monotonically_increasing_id()))
    dealt = dealt.withColumn(lot, F.shiftright(F.col(f"`{at}`"), _RANGE))
    value = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit(0))
    sums = dealt.groupBy(F.col(lot).alias("lot")).agg(F.count(F.lit(1)).alias("rows"), *[F.sum(value(c)).alias(f"sum{k}") for k, c in enumerate(totals.values())])
    before = Window.orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    starts = sums.select("lot", so_far("rows").alias("rows"), *[so_far(f"sum{k}").alias(f"sum{k}") for k in range(len(totals))])
    own = dealt
    if totals:
        within = Window.partitionBy(lot).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
        own = own.withColumns({name: F.coalesce(F.sum(value(c)).over(within), F.lit(0)) for name, c in totals.items()})
    start = free_name([*own.columns], "start")
    placed = own.join(starts.select(F.struct(*starts.columns).alias(start)), F.col(f"`{lot}`") == F.col(f"{start}.lot"))
    place = F.col(f"{start}.rows") + F.col(f"`{at}`").bitwiseAND(F.lit((1 << _RANGE) - 1))
    return placed.select(*[F.col(f"`{c}`") for c in names], place.alias(number), *[(F.col(f"`{name}`") + F.col(f"{start}.sum{k}")).alias(name) for k, name in enumerate(totals)])
