"""Weights, regional averages and imputation on the event indicators."""

from pyspark.sql import functions as F

from panelkit.catalog.registry import query, rounded
from panelkit.catalog.tables import all_nations, day_of, nations, region_map, table
from panelkit.operators.aggregate import fill_summary
from panelkit.operators.complete import axis_of
from panelkit.operators.gaps import complete_and_fill
from panelkit.operators.impute import (
    attach_metadata,
    attach_weight,
    regional_average,
    zero_fill_flagged,
)
from panelkit.operators.joins import lookup
from panelkit.plans.indicators import (
    SERIES,
    economy_indicators,
    filled_indicators,
    imputed_indicators,
)
from panelkit.session import durable

DAYS = list(range(19723, 19753))

# type, driver, driver_name, unit, weight, duplicated, na_is_zero, line
INDICATORS = [
    ("am", "click", "Clicks", "% of visits", "population", None, None, 1),
    ("pm", "click", "Late clicks", "count", "gdp", None, "TRUE", 2),
    ("am", "view", "Views", "Index, 0-100", "GDP", "FALSE", None, 3),
    ("pm", "view", "Late views", "Index, 0-100", "GDP", "TRUE", None, 4),
    ("am", "purchase", "Purchases", "billion USD", "arableLand", None, "FALSE", 5),
    ("am", "signup", "Signups", "TWh generation", "gdp", None, "TRUE", 6),
    ("pm", "signup", "Late signups", "count", "population", None, "TRUE", 7),
    ("am", "error", "Errors", None, None, None, None, 8),
    ("pm", "error", "Late errors", "thousand", "gdp", None, None, 9),
]
_COLUMNS = ["type", "driver", "driver_name", "unit", "weight", "duplicated", "na_is_zero"]


def indicator_mapping(spark):
    rows = F.inline(
        F.array(
            *[
                F.struct(
                    *[F.lit(v).cast("string").alias(c) for c, v in zip(_COLUMNS, row)],
                    F.lit(row[-1]).alias("__line"),
                )
                for row in INDICATORS
            ]
        )
    )
    return spark.range(1).select(rows)


def _sql_value(v) -> str:
    return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)


MAPPING = "mapping AS (SELECT * FROM (VALUES {}) t({}, line))".format(
    ", ".join("(" + ", ".join(_sql_value(v) for v in row) + ")" for row in INDICATORS),
    ", ".join(_COLUMNS),
)


def raw_indicators(spark, sf_dir):
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            F.col("user_id").cast("string").alias("region"),
            F.when(F.hour("ts") < 12, "am").otherwise("pm").alias("type"),
            F.col("event_type").alias("driver"),
            day_of(F.col("ts")).alias("period"),
        )
        .agg(F.sum("value").alias("value"))
    )


def all_series(raw):
    """Every user with every indicator, also those a user has no event of."""
    indicators = F.inline(
        F.array(
            *[
                F.struct(F.lit(t).alias("type"), F.lit(d).alias("driver"))
                for t in ("am", "pm")
                for d in ("click", "view", "purchase", "signup", "error")
            ]
        )
    )
    return raw.select("region").distinct().select("region", indicators)


def customer_weights(spark, sf_dir):
    """GDP and population of a customer: value of all and of final orders, the same on every day."""
    final = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").cast("string").alias("region"))
        .agg(F.sum("o_totalprice").alias("gdp"), F.sum(final).alias("pop"))
    )


def customer_groups(spark, sf_dir):
    """Customers with a balance belong to their nation, others to no group."""
    nation = nations(spark, sf_dir)
    return (
        table(spark, sf_dir, "customer")
        .filter("c_acctbal >= 0")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").cast("string").alias("CountryCode"), F.col("n_name").alias("RegionCode"))
    )


# the steps after the raw cells, for entities, indicators and periods in question
DENSE = """grid AS (
  SELECT u.region, t.type, t.driver, p.period, raw.value
  FROM entities u CROSS JOIN indicators t CROSS JOIN periods p
  LEFT JOIN raw ON raw.region = u.region AND raw.type = t.type AND raw.driver = t.driver AND raw.period = p.period),
numbered AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY region, type, driver ORDER BY period) AS i FROM grid),
points AS (
  SELECT *,
    LAST_VALUE(value IGNORE NULLS) OVER up AS pv,
    LAST_VALUE(CASE WHEN value IS NOT NULL THEN i END IGNORE NULLS) OVER up AS pi,
    FIRST_VALUE(value IGNORE NULLS) OVER down AS nv,
    FIRST_VALUE(CASE WHEN value IS NOT NULL THEN i END IGNORE NULLS) OVER down AS ni
  FROM numbered
  WINDOW up AS (PARTITION BY region, type, driver ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         down AS (PARTITION BY region, type, driver ORDER BY period ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
dense AS (
  SELECT region, type, driver, period,
         COALESCE(value, pv + (nv - pv) * (i - pi) / (ni - pi), pv, nv) AS value FROM points)"""

DESCRIBED = f"""{DENSE},
{MAPPING},
described AS (
  SELECT dense.*, m.driver_name, m.unit, m.weight,
         COALESCE(m.duplicated = 'TRUE', FALSE) AS duplicated, COALESCE(m.na_is_zero = 'TRUE', FALSE) AS na_is_zero
  FROM dense LEFT JOIN mapping m ON m.type = dense.type AND m.driver = dense.driver
  WHERE NOT COALESCE(m.duplicated = 'TRUE', FALSE)),
first_line AS (SELECT * FROM mapping WHERE line IN (SELECT MIN(line) FROM mapping GROUP BY driver)),
filled AS (
  SELECT region, type, driver, period, value, driver_name, unit, weight FROM described WHERE NOT na_is_zero
  UNION ALL
  SELECT d.region, f.type, d.driver, d.period, COALESCE(d.value, 0), f.driver_name, f.unit, f.weight
  FROM described d LEFT JOIN first_line f ON f.driver = d.driver WHERE d.na_is_zero)"""

IMPUTED = """weighted AS (
  SELECT f.region, f.type, f.driver, f.period, f.value, f.driver_name, f.unit, g.RegionCode,
         CASE WHEN lower(f.weight) = 'gdp' THEN 'gdp' ELSE 'pop' END AS weight,
         CASE WHEN lower(f.weight) = 'gdp' THEN c.gdp ELSE c.pop END AS weight_val
  FROM filled f LEFT JOIN weights c ON c.region = f.region LEFT JOIN groups g ON g.region = f.region),
averages AS (
  SELECT RegionCode, driver, driver_name, unit, weight, period,
         CASE WHEN COUNT(*) = COUNT(weight_val) THEN SUM(value * weight_val) / NULLIF(SUM(weight_val), 0) END AS reg_avg,
         COALESCE(SUM(weight_val), 0) AS reg_weight_sum
  FROM weighted WHERE value IS NOT NULL GROUP BY ALL),
imputed AS (
  SELECT w.region, w.type, w.driver, w.driver_name, w.unit, w.weight, w.period, w.value AS value_original,
         CASE WHEN w.value IS NOT NULL THEN w.value
              WHEN regexp_matches(lower(w.unit), '%|per capita|index|ratio|boolean') THEN a.reg_avg
              ELSE a.reg_avg * (w.weight_val / NULLIF(a.reg_weight_sum, 0)) END AS value_filled,
         regexp_matches(lower(w.unit), '%|per capita|index|ratio|boolean') AS is_percent_like,
         CASE WHEN w.value IS NOT NULL THEN 'original'
              WHEN regexp_matches(lower(w.unit), '%|per capita|index|ratio|boolean') THEN 'filled_no_scaling'
              ELSE 'filled_scaled' END AS fill_type,
         w.weight_val
  FROM weighted w LEFT JOIN averages a
    ON a.RegionCode IS NOT DISTINCT FROM w.RegionCode AND a.driver IS NOT DISTINCT FROM w.driver
   AND a.driver_name IS NOT DISTINCT FROM w.driver_name AND a.unit IS NOT DISTINCT FROM w.unit
   AND a.weight IS NOT DISTINCT FROM w.weight AND a.period = w.period)"""

# per user
FILLED = f"""raw AS (
  SELECT CAST(user_id AS VARCHAR) AS region, CASE WHEN hour(ts) < 12 THEN 'am' ELSE 'pm' END AS type,
         event_type AS driver,
         CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS period, SUM(value) AS value
  FROM events GROUP BY 1, 2, 3, 4),
entities AS (SELECT DISTINCT region FROM raw),
indicators AS (
  SELECT type, driver FROM (SELECT unnest(['am', 'pm']) AS type)
  CROSS JOIN (SELECT unnest(['click', 'view', 'purchase', 'signup', 'error']) AS driver)),
periods AS (SELECT DISTINCT period FROM raw WHERE period BETWEEN {DAYS[0]} AND {DAYS[-1]}),
{DESCRIBED}"""

WEIGHTED = f"""{FILLED},
weights AS (
  SELECT CAST(o_custkey AS VARCHAR) AS region, SUM(o_totalprice) AS gdp,
         SUM(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS pop
  FROM orders GROUP BY 1),
groups AS (
  SELECT CAST(c_custkey AS VARCHAR) AS region, n_name AS RegionCode
  FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_acctbal >= 0),
{IMPUTED}"""

# per nation; cells with little value count as missing, so that some series are empty
BY_NATION = f"""raw AS (
  SELECT n_name AS region, CASE WHEN hour(ts) < 12 THEN 'am' ELSE 'pm' END AS type, event_type AS driver,
         CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS period,
         CASE WHEN SUM(value) > 200 THEN SUM(value) END AS value
  FROM events JOIN customer ON c_custkey = user_id JOIN nation ON n_nationkey = c_nationkey
  GROUP BY 1, 2, 3, 4),
entities AS (SELECT n_name AS region FROM nation),
indicators AS (SELECT DISTINCT type, driver FROM raw),
periods AS (SELECT DISTINCT period FROM raw WHERE period BETWEEN {DAYS[0]} AND {DAYS[-1]}),
{DESCRIBED},
weights AS (
  SELECT n_name AS region, SUM(o_totalprice) AS gdp, SUM(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS pop
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1),
groups AS (SELECT n_name AS region, r_name AS RegionCode FROM nation JOIN region ON r_regionkey = n_regionkey),
{IMPUTED}"""


def _dense(spark, sf_dir):
    raw = raw_indicators(spark, sf_dir)
    return complete_and_fill(raw, SERIES, axis_of(raw, "period"), series=all_series(raw))


def _filled(spark, sf_dir):
    raw = raw_indicators(spark, sf_dir)
    return filled_indicators(raw, all_series(raw), indicator_mapping(spark), ["__line"], DAYS)


def _weighted(spark, sf_dir):
    weighted = attach_weight(_filled(spark, sf_dir), customer_weights(spark, sf_dir))
    return lookup(weighted, customer_groups(spark, sf_dir), {"region": "CountryCode"})


def _imputed(spark, sf_dir):
    return imputed_indicators(
        _filled(spark, sf_dir),
        customer_weights(spark, sf_dir),
        customer_groups(spark, sf_dir),
        cut_lineage=True,
    )


@query(f"""WITH {FILLED}
SELECT region, type, driver, period, ROUND(value, 6) AS value, driver_name, unit, weight, na_is_zero FROM described""")
def metadata_flags(spark, sf_dir):
    out = attach_metadata(_dense(spark, sf_dir), indicator_mapping(spark), ["type", "driver"])
    return rounded(out.drop("duplicated"), places=6)


@query(f"""WITH {FILLED}
SELECT region, type, driver, period, ROUND(value, 6) AS value, driver_name, unit, weight FROM filled""", name="zero_fill_flagged")
def zero_fill_flagged_series(spark, sf_dir):
    mapping = indicator_mapping(spark)
    described = attach_metadata(_dense(spark, sf_dir), mapping, ["type", "driver"])
    out = zero_fill_flagged(described, mapping, ["__line"])
    return rounded(out.drop("duplicated", "na_is_zero"), places=6)


@query(f"""WITH {WEIGHTED}
SELECT region, type, driver, period, weight, ROUND(weight_val, 4) AS weight_val, RegionCode FROM weighted""")
def attach_weight_choice(spark, sf_dir):
    out = _weighted(spark, sf_dir).select(
        "region", "type", "driver", "period", "weight", "weight_val", "RegionCode"
    )
    return rounded(out, "weight_val", places=4)


@query(f"""WITH {WEIGHTED}
SELECT RegionCode, driver, driver_name, unit, weight, period, ROUND(reg_avg, 8) AS reg_avg,
       ROUND(reg_weight_sum, 2) AS reg_weight_sum FROM averages""", name="regional_average")
def regional_average_by_group(spark, sf_dir):
    out = regional_average(_weighted(spark, sf_dir))
    return rounded(rounded(out, "reg_avg"), "reg_weight_sum", places=2)


@query(f"""WITH {WEIGHTED}
SELECT region, type, driver, driver_name, unit, weight, period, ROUND(value_original, 6) AS value_original,
       ROUND(value_filled, 8) AS value_filled, is_percent_like, fill_type, ROUND(weight_val, 4) AS weight_val
FROM imputed""")
def impute_regional(spark, sf_dir):
    out = _imputed(spark, sf_dir).select(
        *["region", "type", "driver", "driver_name", "unit", "weight", "period"],
        *["value_original", "value_filled", "is_percent_like", "fill_type", "weight_val"],
    )
    out = rounded(out, "value_original", places=6)
    return rounded(rounded(out, "value_filled"), "weight_val", places=4)


@query(f"""WITH {WEIGHTED}
SELECT fill_type, COUNT(*) AS n, ROUND(100 * COUNT(*) / SUM(COUNT(*)) OVER (), 1) AS pct
FROM imputed GROUP BY fill_type""", name="fill_summary")
def fill_summary_by_type(spark, sf_dir):
    return fill_summary(_imputed(spark, sf_dir))


def nation_indicators(spark, sf_dir):
    """Raw indicators per nation: events are summed per user before the join."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    per_user = raw_indicators(spark, sf_dir).withColumnRenamed("region", "user")
    return (
        per_user.join(customer, F.col("user").cast("bigint") == F.col("c_custkey"))
        .groupBy("c_nationkey", "type", "driver", "period")
        .agg(F.sum("value").alias("value"))
        .withColumn("value", F.when(F.col("value") > 200, F.col("value")))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("n_name").alias("region"), "type", "driver", "period", "value")
    )


def nation_weights(spark, sf_dir):
    """GDP and population of a nation, the same on every day."""
    final = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))
    per_customer = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.sum("o_totalprice").alias("gdp"), F.sum(final).alias("pop"))
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey")
        .agg(F.sum("gdp").alias("gdp"), F.sum("pop").alias("pop"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("n_name").alias("region"), "gdp", "pop")
    )


@query(f"""WITH {BY_NATION}
SELECT region, type, driver_name, unit, period, ROUND(value_filled, 6) AS value, ROUND(weight_val, 2) AS weight FROM imputed""")
def economy_indicator_panel(spark, sf_dir):
    result = economy_indicators(
        durable(nation_indicators(spark, sf_dir)),
        indicator_mapping(spark),
        ["__line"],
        nation_weights(spark, sf_dir),
        region_map(spark, sf_dir),
        all_nations(spark, sf_dir),
        DAYS,
        cut_lineage=True,
    )
    return rounded(rounded(result.data, places=6), "weight", places=2)
