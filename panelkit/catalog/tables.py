"""Panels made from the test tables, in Spark and as SQL common table expressions.

Facts are summed per join key before they are joined, so a customer or supplier
with a large part of all rows adds one row per year to the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions import in_years, pick, recode, recoded_to
from panelkit.operators.complete import axis_of

YEARS = list(range(1995, 2002))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation key, name and name of its region."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name"
    )


def region_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nations(spark, sf_dir).select(
        F.col("n_name").alias("CountryCode"), F.col("r_name").alias("RegionCode")
    )


def bloc_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return axis_of(nations(spark, sf_dir).filter(F.col("r_name") == "EUROPE"), "n_name")


def all_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return axis_of(table(spark, sf_dir, "nation"), "n_name")


# --- PO: order value per nation, year and market segment -------------------


def orders_panel(spark: SparkSession, sf_dir: str, years: list[int] | None = None) -> DataFrame:
    """Of the listed years only, if there are any; orders of other years are not read."""
    orders = table(spark, sf_dir, "orders")
    if years is not None:
        orders = orders.filter(in_years(F.col("o_orderdate"), years))
    per_customer = (
        orders.groupBy("o_custkey", F.year("o_orderdate").alias("period"))
        .agg(F.sum("o_totalprice").alias("value"))
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    per_nation = (
        per_customer.join(customer, per_customer.o_custkey == customer.c_custkey)
        .groupBy("c_nationkey", "period", F.col("c_mktsegment").alias("category"))
        .agg(F.sum("value").alias("value"))
    )
    nation = table(spark, sf_dir, "nation")
    return per_nation.join(nation, per_nation.c_nationkey == nation.n_nationkey).select(
        F.col("n_name").alias("region"), "period", "category", "value"
    )


PO = """
po AS (
  SELECT n_name AS region, CAST(year(o_orderdate) AS INTEGER) AS period,
         c_mktsegment AS category, SUM(o_totalprice) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2, 3)"""


# --- PE: event value per user, day and event type (with gaps) --------------


def day_of(ts: Column) -> Column:
    return F.unix_date(F.to_date(ts))


def events_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            F.col("user_id").cast("string").alias("region"),
            day_of(F.col("ts")).alias("period"),
            F.col("event_type").alias("category"),
        )
        .agg(F.sum("value").alias("value"))
    )


PE = """
pe AS (
  SELECT CAST(user_id AS VARCHAR) AS region,
         CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS period,
         event_type AS category, SUM(value) AS value
  FROM events GROUP BY 1, 2, 3)"""

# every series on every day, NULL where it has no value
PE_GRID = (
    PE
    + """,
grid AS (
  SELECT s.region, s.category, p.period, pe.value
  FROM (SELECT DISTINCT region, category FROM pe) s
  CROSS JOIN (SELECT DISTINCT period FROM pe) p
  LEFT JOIN pe ON pe.region = s.region AND pe.category = s.category AND pe.period = p.period)"""
)


# --- PI: mean discount in percent per nation, year, instrument labels ------

FLAG_TYPES = {"A": "carbon_tax", "N": "ets", "R": "fee"}
STATUS = {"F": "implemented", "O": "abolished"}
PART_GROUPS = {
    "ECONOMY": "all",
    "SMALL": "bulk",
    "LARGE": "bulk",
    "MEDIUM": "diffuse",
    "STANDARD": "diffuse",
    "PROMO": "other",
}


def instruments_panel(
    spark: SparkSession, sf_dir: str, types: list[str] | None = None, statuses: list[str] | None = None
) -> DataFrame:
    """Of the listed types and statuses only, if there are any; lines of others are not read.

    Parts are joined first and rows summed per supplier before the next join.

    Summing lines per part before the first join would shuffle nearly all of them
    once more. A part with very many lines is left to the join's skew handling,
    which splits its partition.
    """
    part = table(spark, sf_dir, "part").select(
        "p_partkey", recode(F.col("p_type"), PART_GROUPS).alias("sector_group")
    )
    lines = table(spark, sf_dir, "lineitem")
    for column, labels, wanted in (("l_returnflag", FLAG_TYPES, types), ("l_linestatus", STATUS, statuses)):
        if wanted is not None:
            lines = lines.filter(recoded_to(F.col(column), labels, wanted))
    lines = lines.select(
        "l_partkey",
        "l_suppkey",
        F.year("l_shipdate").alias("period"),
        "l_returnflag",
        "l_linestatus",
        F.rint(F.col("l_discount") * 100).cast("long").alias("percent"),
    )
    per_supplier = (
        lines.join(part, lines.l_partkey == part.p_partkey)
        .groupBy("l_suppkey", "period", "l_returnflag", "l_linestatus", "sector_group")
        .agg(F.sum("percent").alias("percent"), F.count(F.lit(1)).alias("n"))
    )
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        per_supplier.join(supplier, per_supplier.l_suppkey == supplier.s_suppkey)
        .groupBy("s_nationkey", "period", "l_returnflag", "l_linestatus", "sector_group")
        .agg((F.sum("percent") / F.sum("n")).alias("value"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("n_name").alias("region"),
            recode(F.col("l_returnflag"), FLAG_TYPES).alias("type"),
            recode(F.col("l_linestatus"), STATUS).alias("status"),
            "sector_group",
            "period",
            "value",
        )
    )


def sql_case(column: str, labels: dict[str, str], default: str = "NULL") -> str:
    whens = " ".join(f"WHEN '{old}' THEN '{new}'" for old, new in labels.items())
    return f"CASE {column} {whens} ELSE {default} END"


PI = f"""
pi AS (
  SELECT n_name AS region,
         {sql_case("l_returnflag", FLAG_TYPES)} AS type,
         {sql_case("l_linestatus", STATUS)} AS status,
         {sql_case("p_type", PART_GROUPS)} AS sector_group,
         CAST(year(l_shipdate) AS INTEGER) AS period,
         SUM(CAST(round(l_discount * 100) AS BIGINT)) / COUNT(*) AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey
       JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY 1, 2, 3, 4, 5)"""


# --- H: order value per nation, year and emission sector -------------------

SECTOR_OF_FINAL = {
    "AUTOMOBILE": "Industrial Combustion",
    "BUILDING": "Power Industry",
    "FURNITURE": "Processes",
    "HOUSEHOLD": "Fuel Exploitation",
    "MACHINERY": "Aviation",
}
SECTOR_OF_OPEN = {
    "AUTOMOBILE": "Transport",
    "BUILDING": "Buildings",
    "FURNITURE": "Agriculture",
    "HOUSEHOLD": "Waste",
    "MACHINERY": "Shipping",
}


def history_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``region, period, variable, pollutant, value`` from orders."""
    final = (F.col("o_orderstatus") == "F").alias("final")
    per_customer = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias("period"), final, "o_orderpriority")
        .agg(F.sum("o_totalprice").alias("value"))
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    segment = F.col("c_mktsegment")
    sector = pick(
        F.col("final"), {True: recode(segment, SECTOR_OF_FINAL), False: recode(segment, SECTOR_OF_OPEN)}
    )
    per_nation = (
        per_customer.join(customer, per_customer.o_custkey == customer.c_custkey)
        .groupBy("c_nationkey", "period", sector.alias("variable"), "o_orderpriority")
        .agg(F.sum("value").alias("value"))
    )
    nation = table(spark, sf_dir, "nation")
    return per_nation.join(nation, per_nation.c_nationkey == nation.n_nationkey).select(
        F.col("n_name").alias("region"),
        "period",
        "variable",
        F.col("o_orderpriority").alias("pollutant"),
        "value",
    )


H = f"""
hist AS (
  SELECT n_name AS region, CAST(year(o_orderdate) AS INTEGER) AS period,
         CASE WHEN o_orderstatus = 'F' THEN {sql_case("c_mktsegment", SECTOR_OF_FINAL)}
              ELSE {sql_case("c_mktsegment", SECTOR_OF_OPEN)} END AS variable,
         o_orderpriority AS pollutant, SUM(o_totalprice) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2, 3, 4)"""
