"""Joins by label.

No join here carries a broadcast hint: Spark broadcasts a side whose size is
below ``spark.sql.autoBroadcastJoinThreshold`` (known from the scan or measured
at run time) and otherwise uses a sort-merge join, splitting hot partitions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions import least_strict, member_of


def null_safe_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "left",
    not_null: list[str] | None = None,
) -> DataFrame:
    """Equi-join in which a NULL key matches a NULL key.

    Keys listed in ``not_null`` are compared with plain equality.
    """
    plain = set(not_null or [])
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        a, b = F.col(k), F.col(f"__r_{k}")
        condition = condition & ((a == b) if k in plain else a.eqNullSafe(b))
    joined = left.join(renamed, condition, how)
    return joined.drop(*[f"__r_{k}" for k in keys])


def lookup(df: DataFrame, dim: DataFrame, on: dict[str, str]) -> DataFrame:
    """Left join to a dimension table, ``on`` mapping left to right key names."""
    renamed = dim.withColumnsRenamed({right: left for left, right in on.items()})
    return df.join(renamed, list(on), "left")


def combine(
    left: DataFrame,
    right: DataFrame,
    op: Callable[[Column, Column], Column],
    keys: list[str],
    value: str = "value",
) -> DataFrame:
    """Cell-by-cell arithmetic on the cells both panels have.

    If ``right`` has fewer key columns than ``left``, its cells apply to all
    categories of the key they share.
    """
    other = right.select(*keys, F.col(value).alias("__rhs"))
    return (
        left.join(other, keys, "inner")
        .withColumn(value, op(F.col(value), F.col("__rhs")))
        .drop("__rhs")
        .select(*left.columns)
    )


def smaller_of(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Cell-by-cell minimum, NULL if either cell is NULL."""
    return combine(left, right, least_strict, keys)


def common_keys(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key also occurs in ``other``."""
    return df.join(other.select(*keys).distinct(), keys, "left_semi")


def missing_keys(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key does not occur in ``other``; NULL matches NULL."""
    return null_safe_join(df, other.select(*keys).distinct(), keys, "left_anti")


def override_with(
    base: DataFrame,
    overlay: DataFrame,
    keys: list[str],
    require_value: bool = False,
) -> DataFrame:
    """All of ``overlay``, and the rows of ``base`` whose key it does not have.

    An overlay row without a value displaces a base row too, unless
    ``require_value`` asks for rows with a value only.
    """
    if require_value:
        overlay = overlay.filter(F.col("value").isNotNull())
    return missing_keys(base, overlay, keys).unionByName(overlay, allowMissingColumns=True)


def override_observed(
    df: DataFrame,
    label: str,
    observed: str,
    targets: list[str],
    keys: list[str],
    require_value: bool = False,
) -> DataFrame:
    """Copy observed rows to every target label; there they displace other rows.

    ``keys`` are the key columns besides ``label``. Rows are matched before the
    copies are made, so the copies never pass through the join. Rows of labels that
    are no target match nothing and stay.
    """
    seen = df.filter(F.col(label) == observed)
    others = df.filter(F.col(label) != observed)
    if require_value:
        seen = seen.filter(F.col("value").isNotNull())
    displacing = seen.select(*[F.col(k).alias(f"__r_{k}") for k in keys]).distinct()
    matches = member_of(F.col(label), targets)
    for k in keys:
        matches = matches & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    kept = others.join(displacing, matches, "left_anti")
    copies = seen.withColumn(label, F.explode(F.array(*[F.lit(t) for t in targets])))
    return kept.unionByName(copies)
