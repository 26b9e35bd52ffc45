"""Lists, labels and patterns the results depend on."""

# --- fixed values: members of the emissions-trading bloc ------------------
BLOC_ID = "ETS_EU"
BLOC_MEMBERS = [
    "AUT", "BEL", "BGR", "HRV", "CYP", "CZE", "DNK", "EST", "FIN", "FRA",
    "DEU", "GRC", "HUN", "IRL", "ITA", "LVA", "LTU", "LUX", "MLT", "NLD",
    "POL", "PRT", "ROU", "SVK", "SVN", "ESP", "SWE", "ISL", "LIE", "NOR",
]

# --- fixed values: emission sectors per sector group ----------------------
SECTOR_GROUPS = {
    "bulk": ["Industrial Combustion", "Power Industry", "Processes", "Fuel Exploitation"],
    "diffuse": ["Buildings", "Transport", "Agriculture", "Waste"],
    "bunkers": ["Aviation", "Shipping"],
}
ECONOMY_WIDE = "all"

# --- fixed values: countries whose covered emissions are set to zero ------
EXCLUDED_COUNTRIES = ["LIE", "MNE", "AND"]

# --- fixed values: instrument label recodes -------------------------------
TYPE_LABELS = {"Carbon tax": "carbon_tax", "Carbon Tax": "carbon_tax", "ETS": "ets"}
STATUS_LABELS = {
    "Implemented": "implemented",
    "Under consideration": "under_consideration",
    "Abolished": "abolished",
    "Under development": "under_development",
}

# --- fixed values: text patterns ------------------------------------------
COVERAGE_PATTERN = (
    r"(\d+\.?\d*)% of jurisdiction emissions, (\d+\.?\d*)% of global emissions"
)
APRIL_PRICE_PATTERN = r"US\$\s*([0-9.,]+) \(([^)]*)\)"
RELATIVE_UNIT_PATTERN = "%|per capita|index|ratio|boolean"
FOUR_DIGIT_YEAR = r"^\d{4}$"

# --- fixed values: years ----------------------------------------------------
TAIL_SOURCE_YEAR = 2023
TAIL_YEARS = [2024, 2025]
HISTORY_YEARS = list(range(2000, 2026))
INDICATOR_YEARS = list(range(2003, 2022))

# --- fixed values: region code repairs and removals -----------------------
CODE_REPAIRS = {"CRC": "CRI", "PS": "PSE"}
CODES_DROPPED = ["XC"]

# --- fixed values: scenario sheet labels ----------------------------------
SCENARIOS = ["SSP1", "SSP2", "SSP3", "SSP4", "SSP5"]
OBSERVED = "Observed"
REGION_DROPPED = "Kosovo"
SCENARIO_DROPPED = "WDI"
URBAN_SHARE = "Population|Urban [Share]"
URBAN_SHARE_MODEL = "Urbanization Model (UNDP, 2022)"
URBAN_SHARE_RELABELLED = "Population|Urban UNDP [Share]"
SUMMED_VARIABLES = [
    "GDP|PPP [Conflict-Adjusted Projections]",
    "Net Migration",
    "Population|Extreme Poverty",
]
GDP_WEIGHTED_VARIABLES = [
    "Value Added|Agriculture [Share]",
    "Value Added|Industry [Share]",
    "Value Added|Services [Share]",
]

# --- fixed values: units and descriptions of the results ------------------
CARBON_OUTPUTS = {
    "emissionsCovered": (
        "Mt CO2",
        "Emissions covered by carbon price instruments in a given country and a sector group",
    ),
    "shareEmissionsCovered": (
        "fraction",
        "Share of emissions covered by carbon price instruments in a given country and a sector group",
    ),
    "carbonPrice": (
        "US$2017/t CO2",
        "Carbon price per sector group based on the World Bank dashboard data",
    ),
    "effectivePrice": (
        "US$2017/t CO2",
        "Effective carbon price per sector group based on the World Bank and historical data",
    ),
}
INDICATOR_OUTPUT = ("unit described in the variable", "Global economy data indicators")
SCENARIO_OUTPUT = ("various", "SSP Extensions data")
