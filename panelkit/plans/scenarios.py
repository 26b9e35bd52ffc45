"""Scenario extensions: observed values override scenarios, weights per variable."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit import constants as K
from panelkit.operators.complete import Axis, axis_of, common_axis, on_axis, to_country_panel
from panelkit.operators.joins import lookup, missing_keys, override_observed
from panelkit.operators.panel import Result, unique_cells
from panelkit.operators.reshape import melt_years, year_columns
from panelkit.session import durable


def clean_scenarios(sheet: DataFrame) -> DataFrame:
    """Long rows without the dropped region and scenario, one label repaired."""
    return (
        melt_years(sheet, pattern=K.FOUR_DIGIT_YEAR)
        .filter(
            (F.col("Region") != K.REGION_DROPPED) & (F.col("Scenario") != K.SCENARIO_DROPPED)
        )
        .withColumn(
            "Variable",
            F.when(
                (F.col("Variable") == K.URBAN_SHARE) & (F.col("Model") == K.URBAN_SHARE_MODEL),
                K.URBAN_SHARE_RELABELLED,
            ).otherwise(F.col("Variable")),
        )
        .drop("Model")
    )


def scenario_panel(
    sheet: DataFrame, names: DataFrame, require_value: bool = False
) -> DataFrame:
    """Scenario rows with observed values copied in and country codes as regions.

    ``names`` is ``(name, code)``; a name it does not have becomes a NULL region.
    """
    merged = override_observed(
        clean_scenarios(sheet),
        "Scenario",
        K.OBSERVED,
        K.SCENARIOS,
        ["Region", "Variable", "period"],
        require_value,
    )
    coded = lookup(merged, names.select("name", "code"), {"Region": "name"})
    return coded.drop("Region").withColumnsRenamed(
        {"code": "region", "Scenario": "scenario", "Variable": "variable", "Unit": "unit"}
    )


def unmatched_names(df: DataFrame, names: DataFrame, region: str = "Region") -> DataFrame:
    """The region names that ``names`` has no code for, with their number of rows: ``name, n``.

    Rows of such names get a NULL region and are not part of a country panel.
    """
    counts = df.groupBy(F.col(region).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return missing_keys(counts, names, ["name"])


def weight_by_variable(df: DataFrame, population: DataFrame, gdp: DataFrame) -> DataFrame:
    """Add the weight of each row: GDP, population, or NULL for summed variables."""
    key = ["region", "period", "scenario"]
    people = population.select(*key, F.col("value").alias("__pop"))
    output = gdp.select(*key, F.col("value").alias("__gdp"))
    weight = (
        F.when(F.col("variable").isin(K.SUMMED_VARIABLES), None)
        .when(F.col("variable").isin(K.GDP_WEIGHTED_VARIABLES), F.col("__gdp"))
        .otherwise(F.col("__pop"))
    )
    return (
        df.join(people.join(output, key, "full"), key, "left")
        .withColumn("weight", weight)
        .drop("__pop", "__gdp")
    )


def scenario_extensions(
    sheet: DataFrame,
    names: DataFrame,
    population: DataFrame,
    gdp: DataFrame,
    countries: Axis,
    require_value: bool = False,
    cut_lineage: bool = False,
) -> Result:
    """Scenario values for the years that all inputs have, with their weights.

    The sheet's years are those of its header. The merged rows are read three times,
    for the keys and the years of the grid and for their values; ``cut_lineage``
    writes them to the checkpoint folder instead of computing them again. Two rows of a cell
    are an error. The result counts its rows ``without_weight``, those of summed variables not
    among them; :func:`unmatched_names` tells which names have no code.
    """
    sheet_years = [int(y) for y in year_columns(sheet, K.FOUR_DIGIT_YEAR)]
    common = common_axis(
        sheet.sparkSession, "period", sheet_years, axis_of(population, "period"), axis_of(gdp, "period")
    )
    data = on_axis(scenario_panel(sheet, names, require_value), "period", common)
    # several names may lack a code; their rows are off the list, but their variables and years count
    data = unique_cells(data, unless=F.col("region").isNull())
    data = to_country_panel(durable(data) if cut_lineage else data, countries)
    result = Result(weight_by_variable(data, population, gdp), *K.SCENARIO_OUTPUT)
    averaged = ~F.col("variable").isin(K.SUMMED_VARIABLES)
    return result.checked(without_weight=averaged & F.col("weight").isNull())
