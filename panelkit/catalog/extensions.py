"""Scenario sheets made from orders: observed rows override scenario rows."""

from pyspark.sql import functions as F

from panelkit import constants as K
from panelkit.catalog.registry import query, rounded
from panelkit.catalog.tables import YEARS, region_map, sql_case, table
from panelkit.functions import member_of, recode
from panelkit.operators.aggregate import aggregate_result
from panelkit.operators.complete import axis_of
from panelkit.operators.joins import lookup, override_observed, override_with
from panelkit.operators.reshape import widen_years
from panelkit.plans.scenarios import clean_scenarios, scenario_extensions, unmatched_names, weight_by_variable
from panelkit.session import durable

PRIORITY_SCENARIO = {
    "1-URGENT": "SSP1",
    "2-HIGH": "SSP2",
    "3-MEDIUM": "SSP3",
    "4-NOT SPECIFIED": "SSP4",
    "5-LOW": "SSP5",
}
VARIABLES = {
    "AUTOMOBILE": "GDP|PPP [Conflict-Adjusted Projections]",
    "BUILDING": "Population|Urban [Share]",
    "FURNITURE": "Value Added|Industry [Share]",
    "HOUSEHOLD": "Net Migration",
    "MACHINERY": "Gini [Index]",
}
OBSERVED_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE"]
LAST_OBSERVED = 1998
ROW = ["Model", "Scenario", "Region", "Variable", "Unit"]


def scenario_rows(spark, sf_dir):
    """Long scenario rows; only early years have an observed value."""
    segment, status = F.col("c_mktsegment"), F.col("o_orderstatus")
    scenario = (
        F.when((status == "F") & member_of(segment, OBSERVED_SEGMENTS), K.OBSERVED)
        .when((status == "P") & (F.col("o_orderpriority") == "5-LOW"), K.SCENARIO_DROPPED)
        .otherwise(recode(F.col("o_orderpriority"), PRIORITY_SCENARIO))
    )
    per_customer = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", "o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("period"))
        .agg(F.sum("o_totalprice").alias("value"))
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    per_nation = (
        per_customer.join(customer, per_customer.o_custkey == customer.c_custkey)
        .groupBy(
            "c_nationkey",
            "period",
            scenario.alias("Scenario"),
            recode(segment, VARIABLES).alias("Variable"),
        )
        .agg(F.sum("value").alias("value"))
    )
    nation = table(spark, sf_dir, "nation")
    name = F.when(F.col("n_name") == "NATION_24", K.REGION_DROPPED).otherwise(F.col("n_name"))
    late = (F.col("Scenario") == K.OBSERVED) & (F.col("period") > LAST_OBSERVED)
    return per_nation.join(nation, per_nation.c_nationkey == nation.n_nationkey).select(
        F.when(F.col("Scenario").isin("SSP1", "SSP2", K.OBSERVED), K.URBAN_SHARE_MODEL)
        .otherwise("Other Model")
        .alias("Model"),
        "Scenario",
        name.alias("Region"),
        "Variable",
        F.lit("unit").alias("Unit"),
        "period",
        F.when(~late, F.col("value")).alias("value"),
    )


def scenario_sheet(spark, sf_dir):
    """The sheet as a table of its own: orders are read once, however often it is used."""
    return durable(widen_years(scenario_rows(spark, sf_dir), ROW, YEARS))


def country_names(spark, sf_dir):
    """Name to code; one name is not listed."""
    return (
        table(spark, sf_dir, "nation")
        .filter(F.col("n_name") != "NATION_23")
        .select(
            F.col("n_name").alias("name"),
            F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("code"),
        )
    )


def scenario_weights(spark, sf_dir):
    """Population (number of orders) and GDP (order value) per scenario."""
    per_customer = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias("period"), "o_orderpriority")
        .agg(F.sum("o_totalprice").alias("gdp"), F.count(F.lit(1)).alias("pop"))
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    per_nation = durable(
        per_customer.join(customer, per_customer.o_custkey == customer.c_custkey)
        .groupBy("c_nationkey", "period", "o_orderpriority")
        .agg(F.sum("gdp").alias("gdp"), F.sum("pop").cast("double").alias("pop"))
        .select(
            F.concat(F.lit("N"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("region"),
            "period",
            recode(F.col("o_orderpriority"), PRIORITY_SCENARIO).alias("scenario"),
            "gdp",
            "pop",
        )
    )
    key = ["region", "period", "scenario"]
    pop = per_nation.select(*key, F.col("pop").alias("value"))
    return pop, per_nation.select(*key, F.col("gdp").alias("value"))


ROWS = f"""long AS (
  SELECT c_nationkey, CAST(year(o_orderdate) AS INTEGER) AS period,
         CASE WHEN o_orderstatus = 'F' AND c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE') THEN 'Observed'
              WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'WDI'
              ELSE {sql_case("o_orderpriority", PRIORITY_SCENARIO)} END AS scenario,
         {sql_case("c_mktsegment", VARIABLES)} AS variable, SUM(o_totalprice) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3, 4),
sheet AS (
  SELECT CASE WHEN n_name = 'NATION_24' THEN 'Kosovo' ELSE n_name END AS region, scenario, variable, period,
         CASE WHEN scenario = 'Observed' AND period > {LAST_OBSERVED} THEN NULL ELSE value END AS value,
         CASE WHEN scenario IN ('SSP1', 'SSP2', 'Observed') THEN 'Urbanization Model (UNDP, 2022)' ELSE 'Other Model' END AS model
  FROM long JOIN nation ON n_nationkey = c_nationkey),
clean AS (
  SELECT k.region, k.scenario,
         CASE WHEN k.variable = 'Population|Urban [Share]' AND k.model = 'Urbanization Model (UNDP, 2022)'
              THEN 'Population|Urban UNDP [Share]' ELSE k.variable END AS variable,
         y.period, s.value
  FROM (SELECT DISTINCT region, scenario, variable, model FROM sheet) k
  CROSS JOIN (SELECT CAST(unnest(range(1995, 2002)) AS INTEGER) AS period) y
  LEFT JOIN sheet s ON s.region = k.region AND s.scenario = k.scenario AND s.variable = k.variable
                   AND s.model = k.model AND s.period = y.period
  WHERE k.region <> 'Kosovo' AND k.scenario <> 'WDI')"""


def _merged(extra: str = "") -> str:
    return f"""{ROWS},
observed AS (SELECT * FROM clean WHERE scenario = 'Observed' {extra}),
merged AS (
  SELECT region, scenario, variable, period, value FROM clean c
  WHERE scenario <> 'Observed' AND NOT EXISTS (
    SELECT 1 FROM observed o WHERE o.region = c.region AND o.variable = c.variable AND o.period = c.period)
  UNION ALL
  SELECT region, s.scenario, variable, period, value
  FROM observed CROSS JOIN (SELECT unnest(['SSP1', 'SSP2', 'SSP3', 'SSP4', 'SSP5']) AS scenario) s)"""


_OUT = "SELECT region, scenario, variable, period, ROUND(value, 4) AS value FROM"
_MATCH = ["Region", "Variable", "period"]


def _lower(df, *region):
    return df.select(
        *(region or [F.col("Region").alias("region")]),
        F.col("Scenario").alias("scenario"),
        F.col("Variable").alias("variable"),
        "period",
        F.round("value", 4).alias("value"),
    )


@query(f"WITH {ROWS} {_OUT} clean")
def scenario_clean(spark, sf_dir):
    return _lower(clean_scenarios(scenario_sheet(spark, sf_dir)))


@query(f"WITH {_merged()} {_OUT} merged")
def observed_override(spark, sf_dir):
    clean = clean_scenarios(scenario_sheet(spark, sf_dir))
    return _lower(override_observed(clean, "Scenario", K.OBSERVED, K.SCENARIOS, _MATCH))


@query(f"WITH {_merged('AND value IS NOT NULL')} {_OUT} merged")
def observed_override_with_value(spark, sf_dir):
    clean = clean_scenarios(scenario_sheet(spark, sf_dir))
    out = override_observed(
        clean, "Scenario", K.OBSERVED, K.SCENARIOS, _MATCH, require_value=True
    )
    return _lower(out)


@query(f"""WITH {ROWS}, base AS (SELECT * FROM clean WHERE scenario <> 'SSP2'),
overlay AS (SELECT * FROM clean WHERE scenario = 'SSP2' AND value IS NOT NULL)
{_OUT} overlay UNION ALL {_OUT} base WHERE NOT EXISTS (
  SELECT 1 FROM overlay o WHERE o.region = base.region AND o.variable = base.variable AND o.period = base.period)""")
def override_one_scenario(spark, sf_dir):
    clean = clean_scenarios(scenario_sheet(spark, sf_dir))
    base = clean.filter(F.col("Scenario") != "SSP2")
    overlay = clean.filter(F.col("Scenario") == "SSP2")
    return _lower(override_with(base, overlay, _MATCH, require_value=True))


@query(f"""WITH {ROWS}
SELECT CASE WHEN c.region = 'NATION_23' THEN NULL ELSE 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') END AS code,
       scenario, variable, period, ROUND(value, 4) AS value
FROM clean c JOIN nation ON n_name = c.region""")
def name_to_code(spark, sf_dir):
    clean = clean_scenarios(scenario_sheet(spark, sf_dir))
    coded = lookup(clean, country_names(spark, sf_dir), {"Region": "name"})
    return _lower(coded, F.col("code"))


@query(f"""WITH {ROWS}
SELECT region AS name, COUNT(*) AS n FROM clean
WHERE region NOT IN (SELECT n_name FROM nation WHERE n_name <> 'NATION_23') GROUP BY 1""", name="unmatched_names")
def unmatched_country_names(spark, sf_dir):
    clean = clean_scenarios(scenario_sheet(spark, sf_dir))
    return unmatched_names(clean, country_names(spark, sf_dir))


WEIGHTS = f"""w AS (
  SELECT 'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS region, CAST(year(o_orderdate) AS INTEGER) AS period,
         {sql_case("o_orderpriority", PRIORITY_SCENARIO)} AS scenario, SUM(o_totalprice) AS gdp,
         CAST(COUNT(*) AS DOUBLE) AS pop
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3),
coded AS (
  SELECT CASE WHEN n_name <> 'NATION_23' THEN 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') END AS region,
         scenario, variable, period, value
  FROM merged JOIN nation ON n_name = merged.region)"""
CLASS = """CASE WHEN variable IN ('GDP|PPP [Conflict-Adjusted Projections]', 'Net Migration', 'Population|Extreme Poverty') THEN NULL
            WHEN variable IN ('Value Added|Agriculture [Share]', 'Value Added|Industry [Share]', 'Value Added|Services [Share]') THEN w.gdp
            ELSE w.pop END"""


@query(f"""WITH {_merged()}, {WEIGHTS}
SELECT c.region, c.scenario, variable, c.period, ROUND(value, 4) AS value, ROUND({CLASS}, 4) AS weight
FROM coded c LEFT JOIN w ON w.region = c.region AND w.scenario = c.scenario AND w.period = c.period""")
def weight_classes(spark, sf_dir):
    clean = clean_scenarios(scenario_sheet(spark, sf_dir))
    merged = _lower(override_observed(clean, "Scenario", K.OBSERVED, K.SCENARIOS, _MATCH))
    coded = lookup(merged, country_names(spark, sf_dir), {"region": "name"}).select(
        F.col("code").alias("region"), "scenario", "variable", "period", "value"
    )
    pop, gdp = scenario_weights(spark, sf_dir)
    return rounded(weight_by_variable(coded, pop, gdp), "weight", places=4)


PANEL = f"""WITH {_merged()}, {WEIGHTS},
listed AS (SELECT 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS region FROM nation WHERE n_name <> 'NATION_23'),
kept AS (
  SELECT scenario, variable, period, region, value
  FROM (SELECT scenario, variable, period, CASE WHEN merged.region = 'NATION_23' THEN NULL ELSE 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') END AS region, value
        FROM merged JOIN nation ON n_name = merged.region) t),
full_panel AS (
  SELECT k.scenario, k.variable, k.period, l.region, kept.value
  FROM (SELECT DISTINCT scenario, variable, period FROM kept) k CROSS JOIN listed l
  LEFT JOIN kept ON kept.scenario = k.scenario AND kept.variable = k.variable AND kept.period = k.period AND kept.region = l.region),
weighted AS (
  SELECT f.region, f.scenario, variable, 'unit' AS unit, f.period, value, {CLASS} AS weight
  FROM full_panel f LEFT JOIN w ON w.region = f.region AND w.scenario = f.scenario AND w.period = f.period)"""


def _extensions(spark, sf_dir):
    names = country_names(spark, sf_dir)
    return scenario_extensions(
        scenario_sheet(spark, sf_dir),
        names,
        *scenario_weights(spark, sf_dir),
        axis_of(names, "code"),
        cut_lineage=True,
    )


@query(f"""{PANEL}
SELECT region, scenario, variable, unit, period, ROUND(value, 4) AS value, ROUND(weight, 4) AS weight FROM weighted""")
def scenario_extension_panel(spark, sf_dir):
    return rounded(_extensions(spark, sf_dir).data, "value", "weight", places=4)


_SUMMED = ", ".join(f"'{v}'" for v in K.SUMMED_VARIABLES)


# summed variables are added up, the others averaged; a weight missing next to a value makes a mean NULL;
# means of amounts in cents lie on the border of two roundings at times, hence the millionth
@query(f"""{PANEL},
classed AS (
  SELECT r_name, scenario, variable, unit, period, value, CASE WHEN value IS NOT NULL THEN weight END AS weight,
         variable IN ({_SUMMED}) AS summed
  FROM weighted JOIN nation ON region = 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') JOIN region r ON n_regionkey = r_regionkey)
SELECT r_name AS region, scenario, variable, unit, period,
       ROUND(0.000001 + CASE WHEN summed THEN COALESCE(SUM(value), 0)
             WHEN COUNT(value) = COUNT(weight) AND SUM(weight) <> 0 THEN SUM(value * weight) / SUM(weight) END, 2) AS value,
       CASE WHEN NOT summed THEN ROUND(COALESCE(SUM(weight), 0), 2) END AS weight
FROM classed GROUP BY r_name, scenario, variable, unit, period, summed""")
def scenario_by_region(spark, sf_dir):
    codes = country_names(spark, sf_dir)
    groups = region_map(spark, sf_dir).join(codes, F.col("CountryCode") == F.col("name"))
    groups = groups.select(F.col("code").alias("CountryCode"), "RegionCode")
    out = aggregate_result(_extensions(spark, sf_dir), groups).data
    return rounded(out.withColumn("value", F.col("value") + 0.000001), "value", "weight", places=2)
