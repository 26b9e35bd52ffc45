"""Numbering rows in an order, without one task that sees them all."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.session import durable


def ranked(df: DataFrame, order: list[str | Column], by: list[str] | None = None, name: str = "rank") -> DataFrame:
    """``df`` with each row's number, from 1, in the given order within its ``by`` group.

    Two passes: the rows are dealt out by ranges of (group, order), sorted where they are and
    written once to the shared folder; then the number of rows of each group in each range
    gives the offset at which the range begins. A group may be the whole table. The order has
    to be total, or ties are numbered as they happen to be written. NULL groups are a
    group. Runs jobs, and computes ``df`` twice (once to find the ranges), so write an
    expensive one before.
    """
    by = by or []
    ordered = [F.col(c) if isinstance(c, str) else c for c in order]
    keys = [F.col(c) for c in by]
    dealt = df.repartitionByRange(*keys, *ordered).sortWithinPartitions(*keys, *ordered)
    number = F.monotonically_increasing_id()
    fixed = durable(
        dealt.withColumn("__range", F.shiftright(number, 33)).withColumn(
            "__place", number.bitwiseAND(F.lit((1 << 33) - 1))
        )
    )
    held = fixed.groupBy("__range", *by).agg(F.count(F.lit(1)).alias("__n"), F.min("__place").alias("__from"))
    if by:  # one row per range, and per group that begins in it
        before = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
        offset = F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__from") + 1
        named = [F.col(c).alias(f"__{c}") for c in by]
        starts = held.select(F.col("__range").alias("__r"), *named, offset.alias("__offset"))
    else:  # one row per range
        ranges = sorted(held.collect())
        upto = accumulate((r["__n"] for r in ranges), initial=0)
        offsets = [(r["__range"], n - r["__from"] + 1) for r, n in zip(ranges, upto)]
        starts = df.sparkSession.createDataFrame(offsets, "__r bigint, __offset bigint")
    same = F.col("__range") == F.col("__r")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    joined = fixed.join(starts, same)
    return joined.withColumn(name, F.col("__place") + F.col("__offset")).select(*df.columns, name)
