"""Text files written from the test tables and read back by the library's readers."""

import uuid

from pyspark.sql import functions as F

from panelkit.catalog.registry import query, rounded
from panelkit.catalog.tables import PO, SECTOR_OF_FINAL, YEARS, orders_panel, sql_case, table
from panelkit.functions import recode
from panelkit.operators.panel import as_panel, read_panel, unique_cells, write_panel
from panelkit.operators.reshape import melt_years, widen_years
from panelkit.session import work_folder
from panelkit.sources import read_indicator_folder, read_mapping, read_sheet

SEGMENTS = list(SECTOR_OF_FINAL)


def _folder(spark) -> str:
    return f"{work_folder(spark)}/{uuid.uuid4().hex}"


def _write_sheet(wide, title: str) -> str:
    """A small table as one text file: a title line, the header, a record per row."""
    path, spark = _folder(wide.sparkSession), wide.sparkSession
    top = [title + "," * (len(wide.columns) - 1), ",".join(wide.columns)]
    lines = spark.range(1).select(F.posexplode(F.array(*[F.lit(x) for x in top])).alias("at", "value"))
    quoted = [
        F.concat(F.lit('"'), F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
        for c in wide.columns
    ]
    rows = wide.select(F.lit(len(top)).alias("at"), F.concat_ws(",", *quoted).alias("value"))
    lines.unionByName(rows).coalesce(1).sortWithinPartitions("at").select("value").write.text(path)
    return path


@query(f"""WITH {PO}
SELECT CASE k.region WHEN 'NATION_1' THEN 'CRI' WHEN 'NATION_2' THEN 'PSE' ELSE k.region END AS region,
       k.period, 'part' AS type, s || '_total__USD_' AS driver, ROUND(po.value, 2) AS value
FROM (SELECT DISTINCT region, period FROM po) k CROSS JOIN (SELECT unnest({SEGMENTS}) AS s)
LEFT JOIN po ON po.region = k.region AND po.period = k.period AND po.category = s
WHERE k.region <> 'NATION_0'""")
def indicator_folder(spark, sf_dir):
    code = (
        F.when(F.col("region") == "NATION_0", "XC")
        .when(F.col("region") == "NATION_1", "CRC")
        .when(F.col("region") == "NATION_2", "PS")
        .otherwise(F.col("region"))
    )
    wide = (
        orders_panel(spark, sf_dir)
        .groupBy(F.col("region").alias("Country"), code.alias("Code"), F.col("period").alias("Year"))
        .agg(
            *[
                F.round(F.max(F.when(F.col("category") == s, F.col("value"))), 2).alias(
                    f"{s} total (USD)"
                )
                for s in SEGMENTS
            ]
        )
        .withColumn("ContinentCode", F.lit(None).cast("string"))
    )
    path = _folder(spark)
    wide.write.option("header", True).csv(path)
    # the writer's file names have a fixed beginning, the rest differs from run to run
    rows = read_indicator_folder(spark, path)
    return rounded(rows.withColumn("type", F.split_part("type", F.lit("-"), F.lit(1))), places=2)


@query(f"WITH {PO} SELECT region, period, category, ROUND(value, 4) AS value FROM po")
def panel_round_trip(spark, sf_dir):
    raw = orders_panel(spark, sf_dir).select(
        F.col("region").alias("iso"), F.col("period").cast("string").alias("year"), "category", F.col("value").alias("amount")
    )
    panel = unique_cells(as_panel(raw, "iso", "year", "amount"))
    path = _folder(spark)
    write_panel(panel, path)
    return rounded(read_panel(spark, path, panel.schema), places=4)


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS order_key,
       'status ' || o_orderstatus || chr(10) || 'priority "' || o_orderpriority || '",' || chr(10) || 'as of ' || CAST(year(o_orderdate) AS VARCHAR) AS free_text,
       CAST(o_custkey AS VARCHAR) AS customer
FROM orders""")
def sheet_with_line_breaks(spark, sf_dir):
    note = F.concat(
        F.lit("status "), "o_orderstatus", F.lit('\npriority "'), "o_orderpriority", F.lit('",\nas of '), F.year("o_orderdate")
    )
    sheet = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Order key"), note.alias("Free text"), F.col("o_custkey").alias("Customer")
    )
    path = _folder(spark)
    # a file per partition, each with its header
    sheet.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    return read_sheet(spark, path, multi_line=True)


@query(f"""
SELECT CAST(p_partkey AS VARCHAR) AS unique_id, COALESCE({sql_case("p_type", {"SMALL": "bulk", "LARGE": "diffuse"})}, '') AS sector_group
FROM part""")
def mapping_with_blanks(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("unique_id"),
        recode(F.col("p_type"), {"SMALL": "bulk", "LARGE": "diffuse"}).alias("sector_group"),
    )
    path = _folder(spark)
    part.write.option("header", True).option("sep", ";").csv(path)
    return read_mapping(spark, path)


@query("""
SELECT c_mktsegment AS segment, CAST(year(o_orderdate) AS INTEGER) AS period, COUNT(*) AS value
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""")
def sheet_of_text_years(spark, sf_dir):
    per_customer = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias("period"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    counts = (
        per_customer.join(customer, per_customer.o_custkey == customer.c_custkey)
        .groupBy(F.col("c_mktsegment").alias("Market segment"), "period")
        .agg(F.sum("n").alias("value"))
    )
    wide = widen_years(counts, ["Market segment"], YEARS)
    wide = wide.withColumn("Free text", F.lit('counted "by year",\nwithout a limit'))
    sheet = read_sheet(spark, _write_sheet(wide, "Orders by segment"), skip=1, multi_line=True)
    long = melt_years(sheet.drop("free_text"), ["market_segment"], drop_missing=True)
    return long.select(F.col("market_segment").alias("segment"), "period", F.col("value").cast("long"))
