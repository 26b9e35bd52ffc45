"""The panel contract: long rows, unique keys, NULL as the only missing value."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelkit.functions import nan_to_null


@dataclass(frozen=True)
class Result:
    """A panel with a ``value`` and, if it has one, a ``weight`` column.

    ``counts.get`` says after an action on ``data`` how many rows fell below ``minimum`` and
    what else the preparation counts.
    """

    data: DataFrame
    unit: str
    description: str
    minimum: float | None = None
    counts: Observation | None = None

    def checked(self, **conditions: Column) -> Result:
        """The same result with :func:`counted` rows, those below its ``minimum`` among them."""
        if self.minimum is not None:
            conditions["below_minimum"] = F.col("value") < self.minimum
        data, counts = counted(self.data, **conditions)
        return replace(self, data=data, counts=counts)


def as_panel(
    df: DataFrame,
    region: str = "region",
    period: str = "period",
    value: str = "value",
    categories: list[str] | None = None,
) -> DataFrame:
    """Rename and cast to ``region, period, <categories>, value``.

    Columns that are none of the three named ones become categories.
    """
    if categories is None:
        categories = [c for c in df.columns if c not in (region, period, value)]
    return df.select(
        F.col(region).cast("string").alias("region"),
        F.col(period).cast("int").alias("period"),
        *[F.col(c) for c in categories],
        nan_to_null(F.col(value).cast("double")).alias("value"),
    )


def panel_keys(df: DataFrame, *not_keys: str) -> list[str]:
    """Every column but the measures."""
    skipped = {"value", "weight", *not_keys}
    return [c for c in df.columns if c not in skipped]


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def unique_cells(df: DataFrame, keys: list[str] | None = None, unless: Column | None = None) -> DataFrame:
    """``df``, or an error when it is computed if a key has two rows.

    The check is part of the plan and runs no job of its own: one aggregate by key, combined
    map-side, which takes each cell's only row and fails where there is another. A NULL key
    is a key. Without ``keys`` every column but the measures is one. Keys for which ``unless``
    holds may repeat, and one of their rows is kept.
    """
    keys = panel_keys(df) if keys is None else keys
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    message = F.concat(F.lit(f"panel key {keys} occurs twice: "), shown)
    others = [c for c in df.columns if c not in keys]
    rows = F.count(F.lit(1))
    checked = df.groupBy(*keys).agg(*[F.first(c).alias(c) for c in others], rows.alias("__rows"))
    twice = F.col("__rows") > 1
    if unless is not None:
        twice = twice & ~F.coalesce(unless, F.lit(False))
    once = F.when(twice, F.raise_error(message).cast("boolean")).otherwise(True)
    return checked.filter(once).select(*df.columns)


def counted(df: DataFrame, **conditions: Column) -> tuple[DataFrame, Observation]:
    """``df``, and the number of its rows for which each condition holds.

    The counts are taken on the way while ``df`` is computed, without a job of their own;
    they are there after the first action on the result. A stage that runs again counts
    again.
    """
    counts = Observation()
    return df.observe(counts, *[F.count_if(c).alias(name) for name, c in conditions.items()]), counts


def read_panel(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What :func:`write_panel` wrote, with the columns of ``schema`` in their order."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def assert_unique_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Return ``df``, or fail if a key occurs twice. Runs a job."""
    found = duplicate_keys(df, keys).head(5)
    if found:
        raise ValueError(f"panel key {keys} is not unique, e.g. {found}")
    return df


def below_minimum(df: DataFrame, minimum: float) -> DataFrame:
    """Rows that break a declared lower bound."""
    return df.filter(F.col("value") < minimum)


def write_panel(df: DataFrame, path: str, by: str = "period") -> None:
    """Write as Parquet, one folder per ``by`` value, sorted by key inside the files.

    The rebalance hint gathers each folder's rows in few files and splits a
    folder that is much larger than the others.
    """
    order = [c for c in panel_keys(df) if c != by]
    (
        df.hint("rebalance", by)
        .sortWithinPartitions(by, *order)
        .write.mode("overwrite")
        .partitionBy(by)
        .parquet(path)
    )
