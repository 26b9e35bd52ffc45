"""Economy indicators: gaps filled per country, missing countries imputed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit import constants as K
from panelkit.operators.complete import Axis, axis_of, expand, on_axis, to_country_panel
from panelkit.operators.gaps import complete_and_fill
from panelkit.operators.impute import (
    FILL_TYPES,
    attach_metadata,
    attach_weight,
    impute,
    zero_fill_flagged,
)
from panelkit.operators.joins import lookup
from panelkit.operators.panel import Result
from panelkit.session import durable

SERIES = ["region", "type", "driver"]


def clean_indicators(raw: DataFrame, countries: Axis) -> DataFrame:
    """Each indicator in every official country and every year, NULL where it was absent."""
    return to_country_panel(raw.select(*SERIES, "period", "value"), countries)


def series_of(raw: DataFrame, countries: Axis) -> DataFrame:
    """The (region, type, driver) series that must exist: each indicator in each country."""
    indicators = raw.select("type", "driver").distinct()
    return expand(indicators, countries, "region")


def filled_indicators(
    raw: DataFrame,
    series: DataFrame,
    mapping: DataFrame,
    mapping_order: list[str],
    years: Sequence[int] | None = None,
    axis: Axis | None = None,
) -> DataFrame:
    """Gap-filled series with metadata, flagged indicators filled with 0.

    The years come first, so values outside them never shape a fill. Every series
    gets every wanted year on ``axis``, by default those of ``raw``; as the grid is dense,
    completing driver and period afterwards would add nothing.
    """
    years = K.INDICATOR_YEARS if years is None else years
    within = raw.filter(F.col("period").isin(list(years)))
    wanted = axis_of(within, "period") if axis is None else on_axis(axis, "period", list(years))
    dense = complete_and_fill(within, SERIES, wanted, series=series)
    described = attach_metadata(dense, mapping, ["type", "driver"])
    return zero_fill_flagged(described, mapping, mapping_order)


def imputed_indicators(
    filled: DataFrame,
    weights: DataFrame,
    groups: DataFrame,
    cut_lineage: bool = False,
) -> DataFrame:
    """Values with weights, region groups and, where missing, the imputed value.

    ``weights`` is a :func:`weight_table`, or ``region, gdp, pop`` if they do not vary in time.
    The rows are read twice, for the averages and for the fill. ``cut_lineage``
    writes them to the checkpoint folder once instead of computing them twice.
    """
    weighted = attach_weight(filled, weights)
    grouped = lookup(
        weighted, groups.select("CountryCode", "RegionCode"), {"region": "CountryCode"}
    )
    return impute(durable(grouped) if cut_lineage else grouped)


def economy_indicators(
    raw: DataFrame,
    mapping: DataFrame,
    mapping_order: list[str],
    weights: DataFrame,
    groups: DataFrame,
    countries: Axis,
    years: Sequence[int] | None = None,
    cut_lineage: bool = False,
) -> Result:
    """Indicator values and weights per (region, type, driver_name, unit, period).

    The years are those of all regions in ``raw``, also of those not on the country list.
    ``weights`` is a :func:`weight_table`, or ``region, gdp, pop`` if they do not vary in time.
    Two values of a cell are an error. The result counts its rows per way of filling.
    """
    filled = filled_indicators(
        on_axis(raw, "region", countries),
        series_of(raw, countries),
        mapping,
        mapping_order,
        years,
        axis_of(raw, "period"),
    )
    out = imputed_indicators(filled, weights, groups, cut_lineage)
    result = Result(
        out.select(
            *["region", "type", "driver_name", "unit", "period"],
            F.col("value_filled").alias("value"),
            F.col("weight_val").alias("weight"),
            "fill_type",
        ),
        *K.INDICATOR_OUTPUT,
    )
    counts = {label: F.col("fill_type") == label for label in FILL_TYPES}
    result = result.checked(**counts)
    return replace(result, data=result.data.drop("fill_type"))
