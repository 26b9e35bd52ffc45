"""Carbon pricing: from dashboard sheets to covered emissions and prices."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit import constants as K
from panelkit.functions import cells, extract_groups, member_of, recode, sum_zero, to_number
from panelkit.operators.aggregate import times_total, total_by
from panelkit.operators.allocate import (
    allocate_group_total,
    expand_group,
    gather_groups,
    net_of_group,
    spread_groups,
)
from panelkit.operators.complete import (
    Axis,
    axis_of,
    common_axis,
    copy_latest,
    copy_year,
    flag_on_axis,
    grid_of,
    to_country_panel,
)
from panelkit.operators.joins import combine, null_safe_join
from panelkit.operators.panel import Result
from panelkit.operators.reshape import melt_years
from panelkit.session import durable

TAGS = ["unique_id", "region", "region_type", "type", "status", "sector_group"]
PANEL = ["region", "type", "status", "sector_group", "period", "value"]
GROUPS = ["bulk", "diffuse"]
CELL = ["region", "period"]


@dataclass(frozen=True)
class Dashboard:
    """The input tables.

    ``info``, ``price``, ``revenue`` and ``emissions`` are sheets with normalised
    headers, ``history`` is ``(region, period, variable, pollutant, value)``. Only
    covered emissions and what builds on them need the history.
    """

    info: DataFrame
    price: DataFrame
    revenue: DataFrame
    emissions: DataFrame
    region_map: DataFrame
    sector_map: DataFrame
    history: DataFrame | None
    members: Axis = field(default_factory=lambda: list(K.BLOC_MEMBERS))
    bloc: str = K.BLOC_ID
    tail: tuple[int, list[int]] = (K.TAIL_SOURCE_YEAR, K.TAIL_YEARS)


# --- instruments -----------------------------------------------------------


def _maps(board: Dashboard) -> tuple[DataFrame, DataFrame]:
    regions = board.region_map.select("unique_id", "region", "region_type")
    # a blank group is a group without a name, not a missing one
    sectors = board.sector_map.select(
        "unique_id", F.coalesce("sector_group", F.lit("")).alias("sector_group")
    )
    return regions, sectors


def instrument_dim(board: Dashboard) -> DataFrame:
    """One row per instrument: all info columns, its maps, and recoded labels."""
    regions, sectors = _maps(board)
    income = board.price.select("unique_id", "income_group")
    return (
        board.info.join(regions, "unique_id", "left")
        .join(sectors, "unique_id", "left")
        .join(income, "unique_id", "left")
        .withColumn("type", recode(F.col("type"), K.TYPE_LABELS))
        .withColumn("status", recode(F.col("status"), K.STATUS_LABELS))
    )


def _labels(board: Dashboard) -> DataFrame:
    return board.info.select(
        "unique_id",
        "instrument_name",
        recode(F.col("type"), K.TYPE_LABELS).alias("type"),
        recode(F.col("status"), K.STATUS_LABELS).alias("status"),
    )


def _tagged(df: DataFrame, board: Dashboard) -> DataFrame:
    regions, sectors = _maps(board)
    labels = _labels(board).drop("instrument_name")
    return (
        df.join(regions, "unique_id", "left")
        .join(sectors, "unique_id", "left")
        .join(labels, "unique_id", "left")
    )


def coverage_shares(board: Dashboard) -> DataFrame:
    """Covered share of a jurisdiction's emissions, read from its text cell."""
    regions, _ = _maps(board)
    text = F.col("share_of_jurisdiction_emissions_covered")
    covered, _ = extract_groups(text, K.COVERAGE_PATTERN, 2)
    shares = board.info.select(
        "unique_id", (to_number(covered) / 100).alias("emissions_coverage")
    ).filter(F.col("emissions_coverage").isNotNull())
    return (
        shares.join(regions, "unique_id", "left")
        .join(_labels(board).drop("instrument_name"), "unique_id", "left")
        .select("unique_id", "region", "region_type", "type", "status", "emissions_coverage")
    )


def april_prices(board: Dashboard) -> DataFrame:
    """Price on 1 April as text and, without thousands commas, as a number.

    Type and status are the labels of the sheet, not recoded.
    """
    regions, sectors = _maps(board)
    in_dollars, _ = extract_groups(F.col("price_on_1_april"), K.APRIL_PRICE_PATTERN, 2)
    prices = board.info.select(
        "unique_id", "type", "status", in_dollars.alias("price_on_1_april_US")
    ).filter(F.col("price_on_1_april_US").isNotNull())
    return (
        prices.join(regions, "unique_id", "left")
        .join(sectors, "unique_id", "left")
        .select(
            *TAGS,
            "price_on_1_april_US",
            to_number(F.replace("price_on_1_april_US", F.lit(","), F.lit(""))).alias(
                "price_on_1_april"
            ),
        )
    )


# --- sheets to instrument panels -------------------------------------------


def price_panel(board: Dashboard) -> DataFrame:
    long = melt_years(board.price, ["unique_id"], drop_missing=True)
    return _tagged(long, board).select(*TAGS, "period", "value")


def _panel_by_name(sheet: DataFrame, name: str, board: Dashboard) -> DataFrame:
    long = melt_years(sheet, [name], drop_missing=True)
    ids = _labels(board).select("unique_id", "instrument_name")
    named = null_safe_join(long, ids.withColumnRenamed("instrument_name", name), [name])
    return _tagged(named, board).select(*TAGS, "period", "value")


def revenue_panel(board: Dashboard) -> DataFrame:
    return _panel_by_name(board.revenue, "instrument_name", board)


def emission_share_panel(board: Dashboard) -> DataFrame:
    return _panel_by_name(board.emissions, "name_of_the_initiative", board)


def history_cells(board: Dashboard) -> DataFrame:
    """``region, period, sector_group, value``: historical emissions per sector group.

    Everything that is computed from the history starts here, so that the history is read and
    shuffled once: totals, bulk emissions, groups and the latest year share this
    aggregate. Sectors in no group are ``other``. The filter holds for every row; it keeps both
    sums in the aggregate for every reader, so that all of them can use its one shuffle. A
    row without a region counts in totals only, one without a year nowhere.
    """
    label = F.coalesce(
        *[F.when(F.col("variable").isin(K.SECTOR_GROUPS[g]), F.lit(g)) for g in GROUPS], F.lit("other")
    )
    summed = (
        board.history.filter(F.col("period").isNotNull())
        .groupBy(F.coalesce("region", F.lit("")).alias("region"), "period", label.alias("sector_group"))
        .agg(F.sum("value").alias("value"), F.count(F.lit(1)).alias("__rows"))
    )
    kept = summed.filter((F.col("__rows") > 0) | F.col("value").isNull())
    return kept.select("region", "period", "sector_group", F.coalesce("value", F.lit(0.0)).alias("value"))


def _cells_of(cells_of_groups: DataFrame, groups: list[str], prefix: str) -> DataFrame:
    """One row per region and year that has one of the groups, with a column per group.

    The groups are chosen after the aggregate, not by a filter that would reach below
    :func:`history_cells` and make its shuffles differ.
    """
    label = F.col("sector_group")
    sums = [sum_zero(F.when(label == g, F.col("value"))).alias(prefix + g) for g in groups]
    present = F.count_if(label.isin(groups)).alias("__present")
    return cells_of_groups.groupBy(*CELL).agg(*sums, present).filter("__present > 0").drop("__present")


def history_by_sector(board: Dashboard) -> DataFrame:
    """Historical emissions per region, year and sector, last year repeated."""
    source, targets = board.tail
    return (
        copy_year(board.history, source, targets)
        .groupBy("region", "period", "variable")
        .agg(sum_zero(F.col("value")).alias("value"))
    )


def covered_emissions_panel(board: Dashboard) -> DataFrame:
    """Share of global emissions times the global emissions of the year."""
    source, targets = board.tail
    totals = total_by(copy_year(history_cells(board), source, targets), ["period"])
    return times_total(emission_share_panel(board), totals)


# --- country rules ----------------------------------------------------------


def _is_country() -> Column:
    return F.col("region_type") == "country"


def _bulk_rows(kind: str, inside: str) -> Column:
    return (
        F.col(inside)
        & _is_country()
        & (F.col("type") == kind)
        & (F.col("status") == "implemented")
        & (F.col("sector_group") == "bulk")
    )


def net_of_bloc(df: DataFrame, board: Dashboard) -> DataFrame:
    """Copy bloc rows to its members and net the members' own bulk taxes of them."""
    of_bloc = F.col("unique_id") == board.bloc
    changes = {"region_type": F.lit("country")}
    expanded = expand_group(df, of_bloc, board.members, keep=_is_country(), changes=changes)
    copies = expand_group(df, of_bloc, board.members, keep=of_bloc & _is_country(), changes=changes)
    flagged = flag_on_axis(expanded, "region", board.members, "__member")
    copies = flag_on_axis(copies, "region", board.members, "__member")
    return net_of_group(
        flagged,
        own=_bulk_rows("carbon_tax", "__member"),
        group=copies.filter(_bulk_rows("ets", "__member")).drop("__member"),
        keys=CELL,
    ).drop("__member")


def allocate_bloc(df: DataFrame, board: Dashboard) -> DataFrame:
    """Country rows, and the bloc's covered emissions in proportion to bulk emissions."""
    source, targets = board.tail
    cells_of_groups = copy_year(history_cells(board), source, targets)
    bulk = _cells_of(cells_of_groups, ["bulk"], "").withColumnRenamed("bulk", "value")
    totals = df.filter(F.col("unique_id") == board.bloc).select("period", "value")
    allocated = allocate_group_total(totals, bulk, board.members)
    tags = {
        "unique_id": F.lit(board.bloc),
        "region_type": F.lit("country"),
        "type": F.lit("ets"),
        "status": F.lit("implemented"),
        "sector_group": F.lit("bulk"),
    }
    return df.filter(_is_country()).unionByName(
        allocated.withColumns(tags).select(*df.columns)
    )


def read_dashboard(board: Dashboard, subtype: str = "price") -> DataFrame:
    """One table of the dashboard; only the chosen one is planned."""
    builders = {
        "price": lambda: net_of_bloc(price_panel(board), board).select(*PANEL),
        "revenue": lambda: net_of_bloc(revenue_panel(board), board).select(*PANEL),
        "emissionsCovered": lambda: allocate_bloc(
            covered_emissions_panel(board), board
        ).select(*PANEL),
        "wbCoverage": lambda: coverage_shares(board),
        "priceAprilFirst": lambda: april_prices(board),
    }
    return builders[subtype]()


def dashboard_panel(
    board: Dashboard, countries: Axis, subtype: str = "price", cut_lineage: bool = False
) -> DataFrame:
    """One table on the official country list: absent cells and missing values are 0.

    The table is read twice, for the keys of the grid and for its cells; ``cut_lineage``
    writes it to the checkpoint folder instead of computing it twice.
    """
    rows = read_dashboard(board, subtype)
    return to_country_panel(durable(rows) if cut_lineage else rows, countries, fill=0.0, null_to_zero=True)


# --- result -----------------------------------------------------------------


def gdp_per_capita(
    gdp: DataFrame, population: DataFrame, tail: tuple[int, list[int]] | None = None
) -> DataFrame:
    """GDP per head for the cells both panels have, last year repeated."""
    source, targets = tail or (K.TAIL_SOURCE_YEAR, K.TAIL_YEARS)
    return copy_year(combine(gdp, population, F.try_divide, CELL), source, targets)


def history_by_group(board: Dashboard, years: list[int] | None = None) -> DataFrame:
    """Historical emissions with one column per sector group, absent years copied."""
    return _cells_of(copy_latest(history_cells(board), years or K.HISTORY_YEARS), GROUPS, "hist_")


def carbon_price(
    spark: SparkSession,
    board: Dashboard,
    countries: Axis,
    subtype: str = "effectivePrice",
    history_years: list[int] | None = None,
    excluded: list[str] | None = None,
    cut_lineage: bool = False,
) -> Result:
    """Covered emissions, their share, carbon price or effective price.

    Every input is reduced to one row per (region, year) with the sector groups
    side by side, hash-partitioned alike. The rules between the groups are then
    column expressions, so after these aggregations nothing is shuffled again. Several rows
    of a cell, of several instruments, are added up. The result counts its rows ``below_minimum``.

    Prices and covered emissions are read twice, for their years and their values.
    ``cut_lineage`` writes them to the checkpoint folder instead of computing them
    twice.
    """
    excluded = K.EXCLUDED_COUNTRIES if excluded is None else excluded
    needs_price = subtype in ("carbonPrice", "effectivePrice")
    implemented = F.col("status") == "implemented"

    keep = durable if cut_lineage else (lambda df: df)

    covered_rows = keep(read_dashboard(board, "emissionsCovered"))
    years = axis_of(covered_rows, "period")
    covered = spread_groups(
        covered_rows.filter(implemented),
        CELL,
        [K.ECONOMY_WIDE, *GROUPS],
        prefix="cov_",
    )
    if needs_price:
        price_rows = keep(read_dashboard(board, "price"))
        years = common_axis(spark, "period", years, axis_of(price_rows, "period"))
        price = spread_groups(
            price_rows.filter(implemented),
            CELL,
            [K.ECONOMY_WIDE, *GROUPS],
            prefix="price_",
        )

    history = history_by_group(board, history_years)
    # regions off the list find no row of the grid
    rows = (
        grid_of(spark, region=countries, period=years)
        .join(covered, CELL, "left")
        .join(history, CELL, "left")
    )
    if needs_price:
        rows = rows.join(price, CELL, "left")
    rows = rows.fillna(0.0)

    def group(prefix: str) -> cells.Cells:
        return {g: F.col(prefix + g) for g in GROUPS}

    hist = group("hist_")
    own = cells.split(group("cov_"), F.col(f"cov_{K.ECONOMY_WIDE}"), cells.shares(hist))
    own = {g: F.when(member_of(F.col("region"), excluded), 0.0).otherwise(c) for g, c in own.items()}
    capped = cells.cap(cells.reallocate(own, hist), hist)
    share = cells.coverage(capped, hist)
    if subtype == "emissionsCovered":
        measures = {"value": capped}
    elif subtype == "shareEmissionsCovered":
        measures = {"value": share, "weight": hist}
    elif needs_price:
        prices = cells.fold(group("price_"), F.col(f"price_{K.ECONOMY_WIDE}"))
        if subtype == "effectivePrice":
            prices = {g: prices[g] * share[g] for g in GROUPS}
        measures = {"value": prices, "weight": hist}
    else:
        raise ValueError(f"unknown subtype {subtype}")
    unit, description = K.CARBON_OUTPUTS[subtype]
    return Result(gather_groups(rows, CELL, measures), unit, description, minimum=0.0).checked()
