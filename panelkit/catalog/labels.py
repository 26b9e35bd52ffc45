"""Reshaping, labels and text cells."""

from pyspark.sql import functions as F

from panelkit.catalog.registry import query, rounded
from panelkit.catalog.tables import (
    FLAG_TYPES,
    PART_GROUPS,
    PI,
    PO,
    YEARS,
    instruments_panel,
    orders_panel,
    sql_case,
    table,
)
from panelkit.functions import extract_groups, is_relative_unit, recode
from panelkit.operators.panel import duplicate_keys
from panelkit.operators.reshape import (
    align_columns,
    drop_constant_columns,
    melt_years,
    normalise_headers,
    widen_years,
)

_WIDE = ", ".join(
    f'ROUND(SUM(CASE WHEN period = {y} THEN value END), 4) AS "{y}"' for y in YEARS
)
UNITS = {
    "ECONOMY": "% of GDP",
    "SMALL": "Index, 0-100",
    "MEDIUM": "Electricity Generation, TWh",
    "LARGE": "USD per capita",
    "PROMO": "billion USD",
}


@query(f"WITH {PO} SELECT region, category, {_WIDE} FROM po GROUP BY region, category", name="widen_years")
def widen_years_columns(spark, sf_dir):
    wide = widen_years(orders_panel(spark, sf_dir), ["region", "category"], YEARS)
    return rounded(wide, *[str(y) for y in YEARS], places=4)


@query(f"""WITH {PO}
SELECT k.region, k.category, CAST(y.period AS INTEGER) AS period, ROUND(po.value, 4) AS value
FROM (SELECT DISTINCT region, category FROM po) k
CROSS JOIN (SELECT unnest([1995, 1996, 1997, 1998, 1999, 2000, 2001]) AS period) y
LEFT JOIN po ON po.region = k.region AND po.category = k.category AND po.period = y.period""", name="melt_years")
def melt_years_rows(spark, sf_dir):
    wide = widen_years(orders_panel(spark, sf_dir), ["region", "category"], YEARS)
    return rounded(melt_years(normalise_headers(wide)), places=4)


@query(f"""WITH {PO}
SELECT region, category, period, ROUND(value, 4) AS value FROM po WHERE period IN (1999, 2000)""")
def melt_chosen_years(spark, sf_dir):
    kept = [1999, 2000]
    wide = widen_years(orders_panel(spark, sf_dir, kept), ["region", "category"], YEARS)
    long = melt_years(wide, pattern=r"^\d{4}$", keep=kept, drop_missing=True)
    return rounded(long, places=4)


@query(f"""
SELECT {sql_case("l_returnflag", {"A": "carbon_tax", "N": "ets"})} AS type,
       CASE WHEN l_linestatus = 'F' THEN 'implemented' END AS status,
       COUNT(*) AS n, SUM(l_quantity) AS quantity
FROM lineitem GROUP BY 1, 2""")
def recode_labels(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy(
        recode(F.col("l_returnflag"), {"A": "carbon_tax", "N": "ets"}).alias("type"),
        recode(F.col("l_linestatus"), {"F": "implemented"}).alias("status"),
    ).agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


@query("""
SELECT CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN '5-LOW (pending)'
            WHEN o_orderpriority = '1-URGENT' THEN '1-TOP'
            ELSE o_orderpriority END AS label,
       o_orderstatus AS status, COUNT(*) AS n
FROM orders GROUP BY 1, 2""")
def relabel_when(spark, sf_dir):
    label = F.when(
        (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P"), "5-LOW (pending)"
    ).otherwise(F.col("o_orderpriority"))
    orders = (
        table(spark, sf_dir, "orders")
        .withColumn("label", label)
        .replace({"1-URGENT": "1-TOP"}, subset=["label"])
    )
    return orders.groupBy("label", F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(r"""
SELECT CASE WHEN regexp_matches(props, '"(\w)": ([1-9]\d)\}') THEN regexp_extract(props, '"(\w)": ([1-9]\d)\}', 1) END AS name,
       CASE WHEN regexp_matches(props, '"(\w)": ([1-9]\d)\}') THEN regexp_extract(props, '"(\w)": ([1-9]\d)\}', 2) END AS number,
       COUNT(*) AS n
FROM events GROUP BY 1, 2""")
def regex_extract_two(spark, sf_dir):
    name, number = extract_groups(F.col("props"), r'"(\w)": ([1-9]\d)\}', 2)
    return (
        table(spark, sf_dir, "events")
        .groupBy(name.alias("name"), number.alias("number"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(f"""
SELECT regexp_matches(lower({sql_case("p_type", UNITS)}), '%|per capita|index|ratio|boolean') AS relative,
       COUNT(*) AS n, ROUND(SUM(p_retailprice), 4) AS price
FROM part GROUP BY 1""")
def relative_unit_flag(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    out = part.groupBy(is_relative_unit(recode(F.col("p_type"), UNITS)).alias("relative")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("p_retailprice").alias("price")
    )
    return rounded(out, "price", places=4)


@query(f"""WITH {PI}
SELECT region, sector_group, period, ROUND(value, 8) AS value FROM pi
WHERE type = 'ets' AND status = 'implemented'""", name="drop_constant_columns")
def drop_constant_columns_kept(spark, sf_dir):
    pi = instruments_panel(spark, sf_dir, types=["ets"], statuses=["implemented"])
    return rounded(drop_constant_columns(pi))


@query(f"""
SELECT p_brand AS brand, group_name AS "group", COUNT(*) AS n
FROM (SELECT p_brand, {sql_case("p_type", PART_GROUPS)} AS group_name FROM part) t
GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def duplicate_panel_keys(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("brand"), recode(F.col("p_type"), PART_GROUPS).alias("group")
    )
    return duplicate_keys(part, ["brand", "group"])


@query(f"""
SELECT {sql_case("l_returnflag", FLAG_TYPES)} AS type, l_linestatus AS status, COUNT(*) AS n
FROM lineitem GROUP BY 1, 2
UNION ALL
SELECT NULL, o_orderstatus, COUNT(*) FROM orders GROUP BY o_orderstatus""")
def union_by_name(spark, sf_dir):
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            recode(F.col("l_returnflag"), FLAG_TYPES).alias("type"),
            F.col("l_linestatus").alias("status"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
    orders = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderstatus").alias("status"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    both = lines.unionByName(orders, allowMissingColumns=True)
    return align_columns(both, lines)
