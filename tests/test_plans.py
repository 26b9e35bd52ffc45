"""The three preparations on small hand-computed inputs, read from text files."""

import pytest
from conftest import cells

from panelkit.operators.aggregate import aggregate_regions
from panelkit.plans.carbon import Dashboard, carbon_price, instrument_dim, read_dashboard
from panelkit.operators.impute import weight_table
from panelkit.plans.indicators import clean_indicators, economy_indicators
from panelkit.plans.scenarios import clean_scenarios, scenario_extensions, unmatched_names
from panelkit.sources import read_mapping, read_sheet

COUNTRIES = ["DEU", "FRA", "NZL", "LIE"]

INFO = """\
General information
Unique ID,Instrument name,Type,Status,Share of jurisdiction emissions covered,Price on 1 April
Tax_DE,German tax,Carbon tax,Implemented,"45.5% of jurisdiction emissions, 1% of global emissions","US$ 1,234.5 (EUR 1,100)"
Tax_FR,French tax,Carbon Tax,Implemented,n/a,none
ETS_NZ,NZ permits,ETS,Implemented,"50% of jurisdiction emissions, 0.1% of global emissions",US$ 30 (NZD 50)
ETS_EU,EU permits,ETS,Implemented,,
Tax_LI,LI tax,Carbon tax,Implemented,,
Tax_X,Old tax,Carbon tax,Abolished,,
"""
PRICE = """\
Prices
Unique ID,Income group,2022,2023
Tax_DE,High,30,15
Tax_FR,High,10,
ETS_NZ,High,50,60
ETS_EU,,20,20
Tax_LI,High,100,100
Tax_X,High,9,9
"""
REVENUE = """\
Revenue
Instrument name,2022,2023
EU permits,100,
French tax,7,8
"""
EMISSIONS = """\
Shares

Name of the initiative,2022,2023
EU permits,0.1,0.2
French tax,0.05,0.05
NZ permits,0.3,0.01
LI tax,0.2,0.2
"""
REGIONS = """\
unique_id;region;region_type
Tax_DE;DEU;country
Tax_FR;FRA;country
ETS_NZ;NZL;country
ETS_EU;EU;region
Tax_LI;LIE;country
Tax_X;NZL;country
"""
SECTORS = """\
unique_id;sector_group;Status;instrument
Tax_DE;bulk;Implemented;carbonTax
Tax_FR;diffuse;Implemented;carbonTax
ETS_NZ;all;Implemented;ets
ETS_EU;bulk;Implemented;ets
Tax_LI;diffuse;Implemented;carbonTax
Tax_X;;Abolished;
"""
# region: (bulk, diffuse, aviation); the world total is 1000 in each year
HISTORY = {"DEU": (300.0, 100.0, 50.0), "FRA": (100.0, 100.0, 20.0), "NZL": (60.0, 40.0, 30.0), "USA": (100.0, 100.0, 0.0)}


@pytest.fixture(scope="module")
def board(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("board")

    def file(name, text):
        path = folder / name
        path.write_text(text)
        return str(path)

    rows = []
    for region, (bulk, diffuse, aviation) in HISTORY.items():
        for year in (2022, 2023):
            rows += [
                (region, year, "Power Industry", "CO2", bulk * 0.75),
                (region, year, "Processes", "CH4", bulk * 0.25),
                (region, year, "Transport", "CO2", diffuse),
                (region, year, "Aviation", "CO2", aviation),
            ]
    schema = "region string, period int, variable string, pollutant string, value double"
    return Dashboard(
        info=read_sheet(spark, file("info.csv", INFO), skip=1),
        price=read_sheet(spark, file("price.csv", PRICE), skip=1),
        revenue=read_sheet(spark, file("revenue.csv", REVENUE), skip=1),
        emissions=read_sheet(spark, file("emissions.csv", EMISSIONS), skip=2),
        region_map=read_mapping(spark, file("regions.csv", REGIONS)),
        sector_map=read_mapping(spark, file("sectors.csv", SECTORS)),
        history=spark.createDataFrame(rows, schema),
    )


def panel(df):
    return cells(df, "region", "type", "status", "sector_group", "period")


def test_instrument_dimension(board):
    got = {r.unique_id: r for r in instrument_dim(board).collect()}
    assert (got["Tax_FR"].type, got["Tax_FR"].status) == ("carbon_tax", "implemented")
    assert (got["Tax_X"].sector_group, got["Tax_X"].status) == ("", "abolished")
    assert (got["ETS_EU"].region_type, got["ETS_NZ"].income_group) == ("region", "High")


def test_price_is_net_of_the_bloc(board):
    got = panel(read_dashboard(board, "price"))
    bulk_tax = ("carbon_tax", "implemented", "bulk")
    assert got[("DEU", *bulk_tax, 2022)] == 10.0
    assert ("DEU", *bulk_tax, 2023) not in got  # below the bloc price
    assert got[("ISL", "ets", "implemented", "bulk", 2022)] == 20.0
    assert got[("FRA", "carbon_tax", "implemented", "diffuse", 2022)] == 10.0
    assert ("FRA", "carbon_tax", "implemented", "diffuse", 2023) not in got
    assert sum(k[1] == "ets" and k[4] == 2022 for k in got) == 31
    assert not any(k[0] == "EU" for k in got)


def test_revenue_is_copied_in_full(board):
    got = panel(read_dashboard(board, "revenue"))
    assert sum(v for k, v in got.items() if k[1] == "ets") == 30 * 100.0
    assert got[("FRA", "carbon_tax", "implemented", "diffuse", 2023)] == 8.0


def test_text_tables(board):
    coverage = cells(read_dashboard(board, "wbCoverage"), "unique_id", value="emissions_coverage")
    assert coverage == {"Tax_DE": 0.455, "ETS_NZ": 0.5}
    rows = {r.unique_id: r for r in read_dashboard(board, "priceAprilFirst").collect()}
    assert rows["Tax_DE"].price_on_1_april_US == "1,234.5"
    assert rows["Tax_DE"].price_on_1_april == 1234.5
    assert rows["ETS_NZ"].status == "Implemented"
    assert set(rows) == {"Tax_DE", "ETS_NZ"}


def test_bloc_emissions_follow_bulk_emissions(board):
    got = panel(read_dashboard(board, "emissionsCovered"))
    world = 1000.0
    ets = ("ets", "implemented", "bulk")
    # the bloc covers 10 % of the world; members have bulk emissions of 300 and 100
    assert got[("DEU", *ets, 2022)] == pytest.approx(0.1 * world * 300 / 400)
    assert got[("FRA", *ets, 2023)] == pytest.approx(0.2 * world * 100 / 400)
    assert got[("DEU", *ets, 2025)] == 0.0  # history is prolonged, the share is not
    assert got[("NZL", "ets", "implemented", "all", 2022)] == pytest.approx(0.3 * world)


def final(spark, board, subtype):
    result = carbon_price(spark, board, COUNTRIES, subtype)
    return result, {(r.region, r.sector_group, r.period): r for r in result.data.collect()}


def test_covered_emissions(spark, board):
    result, got = final(spark, board, "emissionsCovered")
    assert (result.unit, result.minimum) == ("Mt CO2", 0.0)
    assert got["DEU", "bulk", 2022].value == pytest.approx(75.0)
    # 300 covered over 60 bulk and 40 diffuse: all of both
    assert got["NZL", "bulk", 2022].value == pytest.approx(60.0)
    assert got["NZL", "diffuse", 2022].value == pytest.approx(40.0)
    assert got["NZL", "bulk", 2023].value == pytest.approx(6.0)
    # 50 covered of 100
    assert got["FRA", "diffuse", 2022].value == pytest.approx(50.0)
    assert got["LIE", "diffuse", 2022].value == 0.0
    assert {k[2] for k in got} == {2022, 2023, 2024, 2025}
    assert len(got) == 4 * 2 * 4


def test_shares_and_prices(spark, board):
    _, share = final(spark, board, "shareEmissionsCovered")
    assert share["DEU", "bulk", 2022].value == pytest.approx(0.25)
    assert share["DEU", "bulk", 2022].weight == 300.0
    assert all(0 <= r.value <= 1 for r in share.values())
    _, price = final(spark, board, "carbonPrice")
    assert price["DEU", "bulk", 2022].value == 30.0  # bloc price and the rest of the tax
    assert price["DEU", "bulk", 2023].value == 20.0
    assert price["NZL", "bulk", 2023].value == price["NZL", "diffuse", 2023].value == 60.0
    assert {k[2] for k in price} == {2022, 2023}
    _, effective = final(spark, board, "effectivePrice")
    assert effective["DEU", "bulk", 2022].value == pytest.approx(30.0 * 0.25)
    assert effective["LIE", "diffuse", 2022].value == 0.0


def test_cut_lineage_changes_nothing(spark, board):
    plain = carbon_price(spark, board, COUNTRIES).data
    cut = carbon_price(spark, board, COUNTRIES, cut_lineage=True).data
    keys = ["region", "period", "sector_group"]
    assert cells(plain, *keys) == pytest.approx(cells(cut, *keys))
    groups = spark.createDataFrame([("DEU", "EU"), ("FRA", "EU")], "CountryCode string, RegionCode string")
    got = cells(aggregate_regions(cut, groups), *keys)
    assert got["EU", 2022, "bulk"] == pytest.approx((30 * 0.25 * 300 + 20 * 0.25 * 100) / 400)


def test_economy_indicators(spark, frame):
    raw = frame(
        "region string, period int, type string, driver string, value double",
        [
            ("A", 2003, "t", "share", 10.0),
            ("A", 2005, "t", "share", 20.0),
            ("B", 2004, "t", "share", 40.0),
            ("B", 2001, "t", "share", 99.0),
            ("A", 2003, "t", "output", 6.0),
            ("A", 2003, "t", "copy", 1.0),
            ("A", 1999, "t", "zero", 1.0),
            ("XX", 2003, "t", "share", 1.0),
        ],
    )
    mapping = frame(
        "type string, driver string, driver_name string, unit string, weight string, duplicated string, na_is_zero string, source string, line int",
        [
            ("t", "share", "Share", "% of GDP", "gdp", "", "", "s", 1),
            ("t", "output", "Output", "USD", "population", "FALSE", "FALSE", "s", 2),
            ("t", "copy", "Copy", "USD", "", "TRUE", "", "s", 3),
            ("t", "zero", "Zero", "USD", "", "", "TRUE", "s", 4),
        ],
    )
    schema = "region string, period int, value double"
    years, countries = [2003, 2004, 2005], ["A", "B", "C"]
    gdp = frame(schema, [(r, y, v) for y in years for r, v in (("A", 1.0), ("B", 3.0), ("C", 5.0))])
    pop = frame(schema, [(r, y, v) for y in years for r, v in (("A", 4.0), ("B", 1.0), ("C", 2.0))])
    groups = frame("CountryCode string, RegionCode string", [(c, "G") for c in countries])
    for cut in (False, True):
        result = economy_indicators(
            raw, mapping, ["line"], weight_table(gdp, pop), groups, countries, years, cut_lineage=cut
        )
        got = {(r.region, r.driver_name, r.period): r for r in result.data.collect()}
        assert len(got) == 3 * 3 * 3
        assert got["A", "Share", 2004].value == 15.0  # between two known years
        assert got["B", "Share", 2003].value == 40.0  # 2001 lies outside the years
        assert got["C", "Share", 2004].value == pytest.approx((15 * 1 + 40 * 3) / 4)
        assert got["B", "Output", 2005].value == pytest.approx(6.0 * 1 / 4)
        assert got["C", "Output", 2005].weight == 2.0
        assert got["C", "Zero", 2003].value == 0.0
    cleaned = cells(clean_indicators(raw, countries), "region", "driver", "period")
    assert cleaned["C", "share", 2003] is None and ("XX", "share", 2003) not in cleaned


def test_scenario_extensions(spark, frame):
    urban, share, sums = (
        "Population|Urban [Share]",
        "Value Added|Industry [Share]",
        "Net Migration",
    )
    model = "Urbanization Model (UNDP, 2022)"
    sheet = frame(
        "Model string, Scenario string, Region string, Variable string, Unit string, `2020` string, `2030` string",
        [
            (model, "Observed", "Alpha", urban, "u", "5", None),
            (model, "SSP1", "Alpha", urban, "u", "7", "9"),
            ("M", "SSP1", "Alpha", urban, "u", "1", "2"),
            ("M", "SSP2", "Alpha", share, "u", "3", "4"),
            ("M", "SSP1", "Alpha", sums, "u", "8", "8"),
            ("M", "WDI", "Alpha", sums, "u", "1", "0"),
            ("M", "SSP1", "Kosovo", sums, "u", "1", "1"),
            ("M", "SSP1", "Nowhere", sums, "u", "1", "1"),
        ],
    )
    names = frame("name string, code string", [("Alpha", "AAA"), ("Beta", "BBB")])
    schema = "region string, period int, scenario string, value double"
    pop = frame(schema, [("AAA", 2020, "SSP1", 10.0), ("AAA", 2030, "SSP1", 11.0)])
    gdp = frame(schema, [("AAA", 2020, "SSP2", 20.0), ("AAA", 2040, "SSP2", 21.0)])
    assert [tuple(r) for r in unmatched_names(clean_scenarios(sheet), names).collect()] == [("Nowhere", 2)]
    result = scenario_extensions(sheet, names, pop, gdp, ["AAA", "BBB"])
    got = {(r.region, r.scenario, r.variable, r.period): (r.value, r.weight) for r in result.data.collect()}
    relabelled = "Population|Urban UNDP [Share]"
    assert got["AAA", "SSP1", relabelled, 2020] == (5.0, 10.0)  # observed, not 7
    assert got["AAA", "SSP5", relabelled, 2020] == (5.0, None)
    assert got["AAA", "SSP1", urban, 2020] == (1.0, 10.0)
    assert got["AAA", "SSP2", share, 2020] == (3.0, 20.0)
    assert got["AAA", "SSP1", sums, 2020] == (8.0, None)
    assert got["BBB", "SSP1", sums, 2020] == (None, None)
    assert {k[3] for k in got} == {2020}  # the only year all inputs have
    assert {k[0] for k in got} == {"AAA", "BBB"}
