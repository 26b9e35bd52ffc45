"""Completing grids, copying years, filling gaps."""

from pyspark.sql import functions as F

from panelkit.catalog.registry import query, rounded
from panelkit.catalog.tables import (
    PE,
    PE_GRID,
    PO,
    day_of,
    events_panel,
    orders_panel,
    table,
)
from panelkit.operators.complete import (
    axis_of,
    complete_grid,
    complete_within,
    copy_latest,
    copy_year,
    fill_entities,
    to_country_panel,
)
from panelkit.operators.gaps import (
    complete_and_fill,
    fill_gaps,
    fill_gaps_chunked,
    fill_years,
)

SERIES = ["region", "category"]

# position, previous and next known point of every cell of the grid
POINTS = (
    PE_GRID
    + """,
numbered AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY region, category ORDER BY period) AS i FROM grid),
points AS (
  SELECT *,
    LAST_VALUE(value IGNORE NULLS) OVER up AS pv,
    LAST_VALUE(CASE WHEN value IS NOT NULL THEN i END IGNORE NULLS) OVER up AS pi,
    FIRST_VALUE(value IGNORE NULLS) OVER down AS nv,
    FIRST_VALUE(CASE WHEN value IS NOT NULL THEN i END IGNORE NULLS) OVER down AS ni
  FROM numbered
  WINDOW up AS (PARTITION BY region, category ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         down AS (PARTITION BY region, category ORDER BY period ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""
)
LINE = "pv + (nv - pv) * (i - pi) / (ni - pi)"


def _filled(expr: str) -> str:
    return f"WITH {POINTS} SELECT region, category, period, ROUND({expr}, 6) AS value FROM points"


@query(f"WITH {PE_GRID} SELECT region, category, period, ROUND(value, 6) AS value FROM grid", name="complete_grid")
def complete_grid_events(spark, sf_dir):
    return rounded(complete_grid(events_panel(spark, sf_dir), SERIES), places=6)


# an axis of every minute that has an event
@query("""WITH cells AS (
  SELECT event_type AS category, CAST(epoch(date_trunc('minute', ts)) // 60 AS BIGINT) AS period, SUM(value) AS value
  FROM events GROUP BY 1, 2)
SELECT k.category, p.period, ROUND(c.value, 6) AS value
FROM (SELECT DISTINCT category FROM cells) k CROSS JOIN (SELECT DISTINCT period FROM cells) p
LEFT JOIN cells c ON c.category = k.category AND c.period = p.period""")
def complete_long_axis(spark, sf_dir):
    minutes = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("category"), minute_of(F.col("ts")).alias("period"))
        .agg(F.sum("value").alias("value"))
    )
    return rounded(complete_grid(minutes, ["category"]), places=6)


@query(f"""WITH {PE}, added AS (
  SELECT c.category, r.region FROM (SELECT DISTINCT category FROM pe) c
  CROSS JOIN (SELECT DISTINCT region FROM pe) r
  WHERE NOT EXISTS (SELECT 1 FROM pe WHERE pe.category = c.category AND pe.region = r.region))
SELECT region, category, period, ROUND(value, 6) AS value FROM pe
UNION ALL SELECT region, category, NULL, NULL FROM added""", name="complete_within")
def complete_within_events(spark, sf_dir):
    return rounded(complete_within(events_panel(spark, sf_dir), "region", "category"), places=6)


@query(f"""WITH {PE}
SELECT CAST(c_custkey AS VARCHAR) AS region, k.period, k.category,
       ROUND(CASE WHEN pe.region IS NULL THEN 0 ELSE pe.value END, 6) AS value
FROM (SELECT DISTINCT period, category FROM pe) k CROSS JOIN customer
LEFT JOIN pe ON pe.region = CAST(c_custkey AS VARCHAR) AND pe.period = k.period AND pe.category = k.category""", name="fill_entities")
def fill_entities_zero(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("region"))
    listed = axis_of(customer, "region")
    return rounded(fill_entities(events_panel(spark, sf_dir), listed, fill=0.0), places=6)


@query(f"""WITH {PO}, big AS (SELECT region, period, category, CASE WHEN value >= 3000000 THEN value END AS value FROM po)
SELECT e.region, k.period, k.category, ROUND(CASE WHEN big.region IS NULL THEN 0 ELSE COALESCE(big.value, 0) END, 4) AS value
FROM (SELECT DISTINCT period, category FROM big) k
CROSS JOIN (SELECT unnest(['NATION_1', 'NATION_2', 'NATION_X']) AS region) e
LEFT JOIN big ON big.region = e.region AND big.period = k.period AND big.category = k.category""")
def clean_to_country_list(spark, sf_dir):
    some = orders_panel(spark, sf_dir).withColumn(
        "value", F.when(F.col("value") >= 3000000, F.col("value"))
    )
    listed = ["NATION_1", "NATION_2", "NATION_X"]
    return rounded(to_country_panel(some, listed, fill=0.0, null_to_zero=True), places=4)


@query(f"""WITH {PO}
SELECT region, period, category, ROUND(value, 4) AS value FROM po
UNION ALL
SELECT region, CAST(y AS INTEGER), category, ROUND(value, 4)
FROM po CROSS JOIN (SELECT unnest(range(1993, 2004)) AS y)
WHERE period = (SELECT MAX(period) FROM po) AND y NOT IN (SELECT period FROM po)""")
def copy_latest_year(spark, sf_dir):
    return rounded(copy_latest(orders_panel(spark, sf_dir), range(1993, 2004)), places=4)


@query(f"""WITH {PO}
SELECT region, period, category, ROUND(value, 4) AS value FROM po
UNION ALL SELECT region, CAST(2002 AS INTEGER), category, ROUND(value, 4) FROM po WHERE period = 2000
UNION ALL SELECT region, CAST(2003 AS INTEGER), category, ROUND(value, 4) FROM po WHERE period = 2000""")
def copy_fixed_year(spark, sf_dir):
    return rounded(copy_year(orders_panel(spark, sf_dir), 2000, [2002, 2003]), places=4)


@query(_filled(f"COALESCE(value, {LINE})"))
def interpolate_linear(spark, sf_dir):
    grid = complete_grid(events_panel(spark, sf_dir), SERIES)
    return rounded(fill_gaps(grid, SERIES, parts=("linear",)), places=6)


@query(_filled("COALESCE(value, pv, nv)"))
def fill_locf_nocb(spark, sf_dir):
    grid = complete_grid(events_panel(spark, sf_dir), SERIES)
    return rounded(fill_gaps(grid, SERIES, parts=("forward", "backward")), places=6)


@query(_filled(f"COALESCE(value, {LINE}, pv, nv)"), name="fill_gaps")
def fill_gaps_on_grid(spark, sf_dir):
    return rounded(fill_gaps(complete_grid(events_panel(spark, sf_dir), SERIES), SERIES), places=6)


@query(_filled(f"COALESCE(value, {LINE}, pv, nv)"), name="complete_and_fill")
def complete_and_fill_events(spark, sf_dir):
    pe = events_panel(spark, sf_dir)
    return rounded(complete_and_fill(pe, SERIES, axis_of(pe, "period")), places=6)


@query(_filled(f"COALESCE(value, {LINE}, pv, nv)"), name="fill_gaps_chunked")
def fill_gaps_in_chunks(spark, sf_dir):
    grid = complete_grid(events_panel(spark, sf_dir), SERIES)
    return rounded(fill_gaps_chunked(grid, SERIES, chunk=7), places=6)


def minute_of(ts):
    """Minutes since 1970, read off the clock fields, so no time zone plays a part."""
    return day_of(ts).cast("long") * 1440 + F.hour(ts) * 60 + F.minute(ts)


# five series with a fifth of all events each, on an axis of minutes
@query("""WITH cells AS (
  SELECT event_type AS category, CAST(epoch(date_trunc('minute', ts)) // 60 AS BIGINT) AS period,
         CASE WHEN SUM(value) >= 20 THEN SUM(value) END AS value
  FROM events GROUP BY 1, 2),
points AS (
  SELECT *,
    LAST_VALUE(value IGNORE NULLS) OVER up AS pv,
    LAST_VALUE(CASE WHEN value IS NOT NULL THEN period END IGNORE NULLS) OVER up AS pi,
    FIRST_VALUE(value IGNORE NULLS) OVER down AS nv,
    FIRST_VALUE(CASE WHEN value IS NOT NULL THEN period END IGNORE NULLS) OVER down AS ni
  FROM cells
  WINDOW up AS (PARTITION BY category ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         down AS (PARTITION BY category ORDER BY period ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT category, period, ROUND(COALESCE(value, pv + (nv - pv) * (period - pi) / (ni - pi), pv, nv), 9) AS value
FROM points""")
def fill_long_series(spark, sf_dir):
    cells = (
        table(spark, sf_dir, "events")
        .groupBy(
            F.col("event_type").alias("category"),
            minute_of(F.col("ts")).alias("period"),
        )
        .agg(F.sum("value").alias("value"))
        .withColumn("value", F.when(F.col("value") >= 20, F.col("value")))
    )
    return rounded(fill_gaps_chunked(cells, ["category"], chunk=1440, by="period"), places=9)


@query(f"""WITH {PO}, sparse AS (
  SELECT region, category, period, CASE WHEN period NOT IN (1997, 1998) THEN value END AS value FROM po),
axis AS (SELECT unnest(range(1994, 2003)) AS period),
keys AS (SELECT DISTINCT region, category FROM sparse),
grid AS (
  SELECT k.region, k.category, CAST(a.period AS INTEGER) AS period, s.value FROM keys k CROSS JOIN axis a
  LEFT JOIN sparse s ON s.region = k.region AND s.category = k.category AND s.period = a.period),
points AS (
  SELECT *,
    LAST_VALUE(value IGNORE NULLS) OVER up AS pv,
    LAST_VALUE(CASE WHEN value IS NOT NULL THEN period END IGNORE NULLS) OVER up AS pi,
    FIRST_VALUE(value IGNORE NULLS) OVER down AS nv,
    FIRST_VALUE(CASE WHEN value IS NOT NULL THEN period END IGNORE NULLS) OVER down AS ni
  FROM grid
  WINDOW up AS (PARTITION BY region, category ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         down AS (PARTITION BY region, category ORDER BY period ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT region, category, period,
       ROUND(COALESCE(value, pv + (nv - pv) * (period - pi) / (ni - pi), pv, nv), 4) AS value
FROM points""", name="fill_years")
def fill_years_to_list(spark, sf_dir):
    known = ~F.col("period").isin(1997, 1998)
    sparse = orders_panel(spark, sf_dir).withColumn("value", F.when(known, F.col("value")))
    return rounded(fill_years(sparse, range(1994, 2003)), places=4)
