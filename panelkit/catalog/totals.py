"""Sums, means, region groups and arithmetic between panels."""

from pyspark.sql import functions as F

from panelkit.catalog.registry import query, rounded
from panelkit.catalog.tables import (
    PI,
    PO,
    instruments_panel,
    nations,
    orders_panel,
    region_map,
    table,
)
from panelkit.operators.aggregate import (
    aggregate_regions,
    distinct_counts,
    first_per_key,
    latest_period,
    sum_out,
    times_total,
    total_by,
)
from panelkit.functions import weighted_mean
from panelkit.operators.joins import combine, common_keys, missing_keys, smaller_of
from panelkit.operators.panel import below_minimum

# sum of the customers' balances per nation and segment, those below zero left out
CUSTOMERS = """
cu AS (
  SELECT n_name AS region, c_mktsegment AS category, SUM(CASE WHEN c_acctbal >= 0 THEN c_acctbal END) AS balance
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)"""


def customers(spark, sf_dir):
    per_nation = (
        table(spark, sf_dir, "customer")
        .groupBy("c_nationkey", F.col("c_mktsegment").alias("category"))
        .agg(F.sum(F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))).alias("balance"))
    )
    nation = nations(spark, sf_dir)
    return per_nation.join(nation, per_nation.c_nationkey == nation.n_nationkey).select(
        F.col("n_name").alias("region"), "category", "balance"
    )


@query(f"""WITH {PI}
SELECT region, sector_group, period, ROUND(COALESCE(SUM(value), 0), 8) AS value
FROM pi WHERE status = 'implemented' GROUP BY 1, 2, 3""")
def sum_out_type(spark, sf_dir):
    pi = instruments_panel(spark, sf_dir, statuses=["implemented"])
    return rounded(sum_out(pi.drop("status"), ["type"]))


@query(f"""WITH {PI}, cut AS (
  SELECT region, type, sector_group, period, CASE WHEN value >= 4 THEN value END AS value
  FROM pi WHERE status = 'implemented')
SELECT region, sector_group, period,
       CASE WHEN COUNT(*) = COUNT(value) THEN ROUND(SUM(value), 8) END AS value
FROM cut GROUP BY 1, 2, 3""")
def sum_out_strict(spark, sf_dir):
    pi = instruments_panel(spark, sf_dir, statuses=["implemented"])
    cut = pi.drop("status").withColumn("value", F.when(F.col("value") >= 4, F.col("value")))
    return rounded(sum_out(cut, ["type"], strict=True))


@query(f"""WITH {PO}, total AS (SELECT period, SUM(value) AS total FROM po GROUP BY period),
part_of AS (SELECT region, period, category, value / SUM(value) OVER (PARTITION BY region, period) AS share FROM po)
SELECT s.region, s.period, s.category, ROUND(s.share * t.total, 2) AS value
FROM part_of s LEFT JOIN total t ON t.period = s.period""")
def share_times_total(spark, sf_dir):
    po = orders_panel(spark, sf_dir)
    whole = sum_out(po, ["category"]).withColumnRenamed("value", "whole")
    shares = (
        po.join(whole, ["region", "period"])
        .withColumn("value", F.col("value") / F.col("whole"))
        .drop("whole")
    )
    return rounded(times_total(shares, total_by(po, ["period"])), places=2)


@query(f"""WITH {PO} SELECT period, ROUND(SUM(value), 4) AS value FROM po
WHERE category IN ('BUILDING', 'MACHINERY') GROUP BY period""")
def filtered_total_per_year(spark, sf_dir):
    po = orders_panel(spark, sf_dir).filter(F.col("category").isin("BUILDING", "MACHINERY"))
    return rounded(total_by(po, ["period"]), places=4)


# a missing weight next to a value makes the mean NULL
@query(f"""WITH {PO}, {CUSTOMERS}
SELECT r_name AS region, po.period, po.category,
       CASE WHEN COUNT(*) = COUNT(cu.balance) THEN ROUND(SUM(po.value * cu.balance) / SUM(cu.balance), 2) END AS value,
       ROUND(COALESCE(SUM(cu.balance), 0), 2) AS weight
FROM po LEFT JOIN cu ON cu.region = po.region AND cu.category = po.category
     JOIN nation ON n_name = po.region JOIN region r ON n_regionkey = r_regionkey
GROUP BY 1, 2, 3""")
def aggregate_regions_mean(spark, sf_dir):
    po = orders_panel(spark, sf_dir)
    weights = customers(spark, sf_dir).select("region", "category", F.col("balance").alias("weight"))
    weighted = po.join(weights, ["region", "category"], "left")
    out = aggregate_regions(weighted, region_map(spark, sf_dir))
    return rounded(out, "value", "weight", places=2)


@query(f"""WITH {PO}
SELECT r_name AS region, period, category, ROUND(SUM(value), 4) AS value
FROM po JOIN nation ON n_name = po.region JOIN region r ON n_regionkey = r_regionkey
GROUP BY 1, 2, 3""")
def aggregate_regions_sum(spark, sf_dir):
    out = aggregate_regions(orders_panel(spark, sf_dir), region_map(spark, sf_dir))
    return rounded(out, places=4)


# one missing weight makes the mean of its group NULL
@query(f"""WITH {PO}, {CUSTOMERS}, w AS (
  SELECT r_name, po.period, po.category, po.value,
         CASE WHEN cu.balance >= 40000 OR po.period < 1998 THEN cu.balance END AS weight
  FROM po JOIN cu ON cu.region = po.region AND cu.category = po.category
       JOIN nation ON n_name = po.region JOIN region r ON n_regionkey = r_regionkey)
SELECT r_name AS region, period, category,
       CASE WHEN COUNT(*) = COUNT(weight) THEN ROUND(SUM(value * weight) / SUM(weight), 2) END AS value
FROM w GROUP BY 1, 2, 3""")
def weighted_mean_region(spark, sf_dir):
    po = orders_panel(spark, sf_dir)
    weights = customers(spark, sf_dir).select("region", "category", "balance")
    weight = F.when((F.col("balance") >= 40000) | (F.col("period") < 1998), F.col("balance"))
    groups = region_map(spark, sf_dir).withColumnRenamed("CountryCode", "region")
    joined = (
        po.join(weights, ["region", "category"])
        .withColumn("weight", weight)
        .join(groups, "region")
    )
    out = joined.groupBy(F.col("RegionCode").alias("region"), "period", "category").agg(
        weighted_mean(F.col("value"), F.col("weight")).alias("value")
    )
    return rounded(out, places=2)


@query(f"""WITH {PO}, {CUSTOMERS}
SELECT po.region, po.period, po.category, ROUND(po.value / cu.balance, 6) AS value
FROM po JOIN cu ON cu.region = po.region AND cu.category = po.category""", name="ratio_per_capita")
def ratio_to_balance(spark, sf_dir):
    balance = customers(spark, sf_dir).select(
        "region", "category", F.col("balance").alias("value")
    )
    out = combine(orders_panel(spark, sf_dir), balance, F.try_divide, ["region", "category"])
    return rounded(out, places=6)


@query(f"""WITH {PO}, later AS (SELECT region, CAST(period + 1 AS INTEGER) AS period, category, value FROM po)
SELECT po.region, po.period, po.category, ROUND(LEAST(po.value, later.value), 4) AS value
FROM po JOIN later ON po.region = later.region AND po.period = later.period AND po.category = later.category""")
def smaller_of_two_years(spark, sf_dir):
    po = orders_panel(spark, sf_dir)
    later = po.withColumn("period", F.col("period") + 1)
    return rounded(smaller_of(po, later, ["region", "period", "category"]), places=4)


@query(f"""WITH {PO}
SELECT region, period, category, ROUND(value, 4) AS value FROM po
WHERE period = (SELECT MAX(period) FROM po)""")
def latest_year_rows(spark, sf_dir):
    po = orders_panel(spark, sf_dir)
    return rounded(po.filter(F.col("period") == latest_period(po)), places=4)


@query(f"""WITH {PI}
SELECT COUNT(DISTINCT region) AS region, COUNT(DISTINCT type) AS type,
       COUNT(DISTINCT sector_group) AS sector_group, COUNT(DISTINCT period) AS period FROM pi""")
def distinct_values(spark, sf_dir):
    pi = instruments_panel(spark, sf_dir)
    return distinct_counts(pi.select("region", "type", "sector_group", "period"))


@query("""
SELECT p_brand AS brand, p_type AS type, p_size AS size, p_partkey AS line FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) AS rn FROM part)
WHERE rn = 1""", name="first_per_key")
def first_row_per_key(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("type"),
        F.col("p_size").alias("size"),
        F.col("p_partkey").alias("line"),
    )
    return first_per_key(part, ["brand"], ["size", "line"])


@query(f"""WITH {PI}, {PO}
SELECT region, period, type, status, sector_group, ROUND(value, 8) AS value FROM pi
WHERE (region, period) IN (SELECT (region, period) FROM po WHERE category = 'BUILDING' AND value > 1000000)""")
def common_cells(spark, sf_dir):
    big = orders_panel(spark, sf_dir).filter("category = 'BUILDING' AND value > 1000000")
    return rounded(common_keys(instruments_panel(spark, sf_dir), big, ["region", "period"]))


@query(f"""WITH {PI}, {PO}, big AS (SELECT region, period FROM po WHERE category = 'BUILDING' AND value > 1000000)
SELECT region, period, type, status, sector_group, ROUND(value, 8) AS value FROM pi
WHERE NOT EXISTS (SELECT 1 FROM big WHERE big.region = pi.region AND big.period = pi.period)""")
def missing_cells(spark, sf_dir):
    big = orders_panel(spark, sf_dir).filter("category = 'BUILDING' AND value > 1000000")
    return rounded(missing_keys(instruments_panel(spark, sf_dir), big, ["region", "period"]))


@query("""
SELECT s_name AS region, s_acctbal AS value FROM supplier WHERE s_acctbal < 0""")
def below_declared_minimum(spark, sf_dir):
    balances = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("region"), F.col("s_acctbal").alias("value")
    )
    return below_minimum(balances, 0.0)
