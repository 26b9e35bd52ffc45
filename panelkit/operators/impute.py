"""Imputing missing entities from weighted averages of their region group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions import is_relative_unit, pick, weight_choice, weighted_mean
from panelkit.operators.aggregate import first_per_key
from panelkit.operators.joins import lookup, null_safe_join
from panelkit.operators.gaps import zero_fill

FLAGS = ("duplicated", "na_is_zero")
FILL_TYPES = ("original", "filled_no_scaling", "filled_scaled")
GROUP_KEYS = ["RegionCode", "driver", "driver_name", "unit", "weight", "period"]


def attach_metadata(df: DataFrame, mapping: DataFrame, keys: list[str]) -> DataFrame:
    """Join indicator metadata, read missing flags as FALSE, drop flagged duplicates."""
    meta = mapping.select(*[c for c in mapping.columns if c != "__line"])
    flags = {c: F.coalesce(F.col(c).try_cast("boolean"), F.lit(False)) for c in FLAGS}
    return null_safe_join(df, meta, keys).withColumns(flags).filter(~F.col("duplicated"))


def zero_fill_flagged(
    df: DataFrame, mapping: DataFrame, order: list[str], value: str = "value"
) -> DataFrame:
    """Flagged indicators get 0 where no value is left, and their metadata by driver.

    A driver with several metadata rows takes the first of them in ``order``,
    including its ``type``. Rows that are not flagged pass through unchanged. The
    rows are read once, the flag chooses per column.
    """
    meta = first_per_key(mapping, ["driver"], order)
    replaced = [
        c for c in meta.columns if c in df.columns and c not in ("driver", *FLAGS)
    ]
    meta = meta.select("driver", *[F.col(c).alias(f"__{c}") for c in replaced])
    flag = F.col("na_is_zero")
    joined = zero_fill(lookup(df, meta, {"driver": "driver"}), flag, value)
    return joined.withColumns(
        {c: F.when(flag, F.col(f"__{c}")).otherwise(F.col(c)) for c in replaced}
    ).select(*df.columns)


def weight_table(gdp: DataFrame, population: DataFrame) -> DataFrame:
    """``region, period, gdp, pop, gdp_per_capita`` for every GDP row."""
    left = gdp.select("region", "period", F.col("value").alias("gdp"))
    right = population.select("region", "period", F.col("value").alias("pop"))
    return left.join(right, ["region", "period"], "left").withColumn(
        "gdp_per_capita", F.try_divide("gdp", "pop")
    )


def attach_weight(df: DataFrame, weights: DataFrame) -> DataFrame:
    """Weight name per indicator and, as ``weight_val``, its value for the row.

    ``weights`` has ``region, gdp, pop`` and, if they vary in time, ``period``.
    """
    keys = [k for k in ("region", "period") if k in weights.columns]
    joined = df.join(weights.select(*keys, "gdp", "pop"), keys, "left")
    return (
        joined.withColumn("weight", weight_choice(F.col("weight")))
        .withColumn(
            "weight_val", pick(F.col("weight"), {"gdp": F.col("gdp"), "pop": F.col("pop")})
        )
        .drop("gdp", "pop")
    )


def regional_average(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Weighted mean and weight sum per region group, over rows with a value."""
    known = df.filter(F.col("value").isNotNull())
    return known.groupBy(*(keys or GROUP_KEYS)).agg(
        weighted_mean(F.col("value"), F.col("weight_val")).alias("reg_avg"),
        F.coalesce(F.sum("weight_val"), F.lit(0.0)).alias("reg_weight_sum"),
    )


def impute(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Fill missing values from the regional average and say how each was filled.

    Relative units take the average as it is, absolute ones the average times the
    row's part of the weight sum. The label is set even if no average exists.
    """
    keys = keys or GROUP_KEYS
    averages = regional_average(df, keys)
    joined = null_safe_join(df, averages, keys)
    value, relative = F.col("value"), F.col("is_percent_like")
    scaled = F.col("reg_avg") * F.try_divide(F.col("weight_val"), F.col("reg_weight_sum"))
    return (
        joined.withColumn("is_percent_like", is_relative_unit(F.col("unit")))
        .withColumn(
            "value_filled",
            F.when(value.isNotNull(), value).when(relative, F.col("reg_avg")).otherwise(scaled),
        )
        .withColumn(
            "fill_type",
            F.when(value.isNotNull(), F.lit("original"))
            .when(relative, F.lit("filled_no_scaling"))
            .otherwise(F.lit("filled_scaled")),
        )
        .drop("reg_avg", "reg_weight_sum")
        .withColumnRenamed("value", "value_original")
    )
