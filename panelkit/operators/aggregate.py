"""Aggregations. All of them combine map-side, so a hot key shuffles few rows."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit import constants as K
from panelkit.functions import sum_strict, sum_zero, weighted_mean
from panelkit.operators.joins import lookup
from panelkit.operators.panel import Result, panel_keys


def sum_out(
    df: DataFrame, dims: list[str], value: str = "value", strict: bool = False
) -> DataFrame:
    """Sum over category columns. NULL is skipped, or with ``strict`` passed on."""
    keys = [c for c in df.columns if c not in (value, *dims)]
    total = sum_strict if strict else sum_zero
    return df.groupBy(*keys).agg(total(F.col(value)).alias(value))


def total_by(df: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Sum of a column per key, NULL skipped."""
    return df.groupBy(*keys).agg(sum_zero(F.col(value)).alias(value))


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order.

    An aggregate over (order, row), not a ranking window: a key with very many rows is
    reduced before the shuffle. A window with a limit per group, which Spark applies before the
    shuffle too, sorts all rows by key and order instead of by key; it took a quarter to a half
    longer on six million rows, with a hot key and with few keys.
    """
    others = [c for c in df.columns if c not in keys]
    row = F.struct(*others)
    rank = F.struct(*order)
    return (
        df.groupBy(*keys)
        .agg(F.min_by(row, rank).alias("__row"))
        .select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns])
    )


def latest_period(df: DataFrame, period: str = "period") -> Column:
    """The latest period present, as a scalar for use in an expression."""
    return df.agg(F.max(period)).scalar()


def distinct_counts(df: DataFrame) -> DataFrame:
    """Number of distinct values per column, NULL counting as a value."""
    return df.agg(
        *[
            (F.count_distinct(F.col(c)) + F.max(F.col(c).isNull().cast("int"))).alias(c)
            for c in df.columns
        ]
    )


def aggregate_regions(
    df: DataFrame,
    mapping: DataFrame,
    country: str = "CountryCode",
    group: str = "RegionCode",
    summed: Column | None = None,
) -> DataFrame:
    """Countries to region groups.

    With a ``weight`` column: weighted mean, and the sum of the weights as the new
    weight; where ``summed`` holds, the sum, without a weight. ``summed`` has to be the same in
    all rows of a cell. Without a weight column: sum. Countries that are in no group
    are left out.
    """
    members = mapping.select(F.col(country).alias("region"), F.col(group).alias("__group"))
    keys = [c for c in panel_keys(df) if c != "region"]
    joined = df.join(members, "region", "inner")
    value = F.col("value")
    if "weight" in df.columns:
        weight = F.col("weight")
        mean = weighted_mean(value, weight)
        total = F.coalesce(F.sum(F.when(value.isNotNull(), weight)), F.lit(0.0))
        if summed is not None:
            by_sum = F.bool_and(F.coalesce(summed, F.lit(False)))
            mean = F.when(by_sum, sum_zero(value)).otherwise(mean)
            total = F.when(by_sum, None).otherwise(total)
        measures = [mean.alias("value"), total.alias("weight")]
    else:
        measures = [sum_zero(value).alias("value")]
    return joined.groupBy(F.col("__group").alias("region"), *keys).agg(*measures)


def aggregate_result(result: Result, mapping: DataFrame) -> Result:
    """A preparation's result per region group, by its weights or, without, as a sum.

    Variables that are summed by nature are summed, whatever weights the table has.
    """
    by_nature = "variable" in result.data.columns and "weight" in result.data.columns
    summed = F.col("variable").isin(K.SUMMED_VARIABLES) if by_nature else None
    return replace(result, data=aggregate_regions(result.data, mapping, summed=summed))


def fill_summary(df: DataFrame, label: str = "fill_type") -> DataFrame:
    """Rows per label and their percentage, one decimal.

    The window without a partition sees one row per label only.
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    share = 100 * F.col("n") / F.sum("n").over(Window.partitionBy())
    return counts.withColumn("pct", F.round(share, 1))


def times_total(
    df: DataFrame, totals: DataFrame, period: str = "period", value: str = "value"
) -> DataFrame:
    """A share times the total of its period; without a total the result is NULL."""
    per_period = totals.select(period, F.col(value).alias("__total"))
    return (
        lookup(df, per_period, {period: period})
        .withColumn(value, F.col(value) * F.col("__total"))
        .drop("__total")
    )
