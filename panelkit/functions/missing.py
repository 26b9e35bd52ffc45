"""Column expressions for missing values.

A panel knows one kind of missing value, NULL. NaN turns into NULL where data
comes in; after that these helpers say per operation whether a NULL is skipped,
counts as zero or makes the result NULL.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def to_number(col: Column) -> Column:
    """Text to double; anything that is not a plain number becomes NULL."""
    text = col.cast("string")
    # Java's parser also accepts a type suffix such as "12d"
    return F.when(~text.rlike(r"[dDfF]\s*$"), nan_to_null(text.try_cast("double")))


def sum_zero(col: Column) -> Column:
    """Sum that skips NULL; the sum of nothing is 0."""
    return F.coalesce(F.sum(col), F.lit(0.0))


def sum_strict(col: Column) -> Column:
    """Sum that is NULL as soon as one addend is NULL."""
    return F.when(~F.bool_or(col.isNull()), F.sum(col))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Weighted mean over rows with a value.

    Rows without a value are skipped. A missing weight next to a value makes the
    mean NULL, and so does a total weight of zero.
    """
    has_value = value.isNotNull()
    total = F.sum(F.when(has_value, weight))
    mean = F.try_divide(F.sum(value * weight), total)
    return F.when(~F.bool_or(has_value & weight.isNull()), mean)


def least_strict(a: Column, b: Column) -> Column:
    """Smaller of two values, NULL if either is NULL (``F.least`` skips NULL)."""
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


def ratio_or_zero(a: Column, b: Column) -> Column:
    """``a / b``, 0 where ``b`` is 0, NULL where either is NULL."""
    return F.when(a.isNull() | b.isNull(), None).otherwise(
        F.coalesce(F.try_divide(a, b), F.lit(0.0))
    )


def member_of(col: Column, values: Iterable) -> Column:
    """Membership test that is FALSE, not NULL, for a NULL value."""
    return F.coalesce(col.isin(list(values)), F.lit(False))
