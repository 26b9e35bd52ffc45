"""Between wide sheets and long panels. Column choices use names only, no job."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions import nan_to_null, to_number


def normalise_headers(df: DataFrame) -> DataFrame:
    """Lower-case column names with underscores for spaces."""
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def year_columns(df: DataFrame, pattern: str | None = None, keep: list[int] | None = None) -> list[str]:
    """Columns whose name is a number, or matches ``pattern``; optionally only some years."""

    def is_year(name: str) -> bool:
        if pattern is not None:
            return re.search(pattern, name) is not None
        return re.fullmatch(r"\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*", name) is not None

    names = [c for c in df.columns if is_year(c)]
    return names if keep is None else [c for c in names if int(float(c)) in set(keep)]


def melt_columns(
    df: DataFrame, ids: list[str], columns: list[str], name: str = "driver", value: str = "value"
) -> DataFrame:
    """One row per id and column; cells without a number stay as NULL rows."""
    kinds = dict(df.dtypes)

    def number(c: str):
        return to_number(_c(c)) if kinds[c] == "string" else nan_to_null(_c(c).cast("double"))

    typed = df.select(*[_c(i) for i in ids], *[number(c).alias(c) for c in columns])
    return typed.unpivot([_c(i) for i in ids], [_c(c) for c in columns], name, value)


def melt_years(
    df: DataFrame,
    ids: list[str] | None = None,
    pattern: str | None = None,
    keep: list[int] | None = None,
    drop_missing: bool = False,
) -> DataFrame:
    """Year columns to rows ``ids, period, value``.

    Years outside ``keep`` are never read: they are left out of the projection.
    """
    years = year_columns(df, pattern, keep)
    if ids is None:
        every_year = set(year_columns(df, pattern))
        ids = [c for c in df.columns if c not in every_year]
    long = melt_columns(df, ids, years, "period", "value")
    long = long.withColumn("period", F.col("period").cast("double").cast("int"))
    return long.filter(F.col("value").isNotNull()) if drop_missing else long


def widen_years(df: DataFrame, ids: list[str], years: list[int]) -> DataFrame:
    """Rows to one column per year, in one aggregation and so one shuffle.

    The years are given, so no job looks for them. A year that a key has twice is an
    error when the rows are made.
    """

    def one(year: int) -> Column:
        here = F.col("period") == year
        twice = F.raise_error(F.lit(f"a key has year {year} more than once"))
        return F.when(F.count(F.when(here, 1)) > 1, twice).otherwise(F.max(F.when(here, F.col("value"))))

    return df.groupBy(*ids).agg(*[one(y).alias(str(y)) for y in years])


def align_columns(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like``, in its order."""
    return df.select(*[_c(c) for c in like.columns])


def drop_constant_columns(df: DataFrame) -> DataFrame:
    """Keep columns with more than one value, NULL counting as a value. Runs a job.

    A column varies if its smallest and largest value differ or if it has both
    NULL and other values, so one aggregate with fixed-size state answers it
    for all columns, however many values they have.
    """
    if not df.columns:
        return df
    varies = [
        F.coalesce(
            (F.min(_c(c)) != F.max(_c(c)))
            | (F.bool_or(_c(c).isNull()) & F.bool_or(_c(c).isNotNull())),
            F.lit(False),
        ).alias(f"v{i}")
        for i, c in enumerate(df.columns)
    ]
    row = df.agg(*varies).first()
    return df.select(*[_c(c) for c, keep in zip(df.columns, row) if keep])


def _c(name: str):
    """Column by its literal name, also if the name has dots or commas."""
    return F.col("`" + name.replace("`", "``") + "`")
