"""The carbon pricing preparation on a dashboard made from line items and orders.

An instrument is a (supplier nation, return flag, line status); the bloc's own
instrument sums the European permits.
"""

from pyspark.sql import functions as F

from panelkit import constants as K
from panelkit.catalog.allocation import SQL_GROUPS
from panelkit.catalog.registry import query, rounded
from panelkit.catalog.tables import (
    H,
    YEARS,
    all_nations,
    bloc_members,
    history_panel,
    nations,
    region_map,
    table,
)
from panelkit.operators.aggregate import aggregate_result, total_by
from panelkit.operators.reshape import widen_years
from panelkit.plans.carbon import (
    Dashboard,
    april_prices,
    carbon_price,
    coverage_shares,
    covered_emissions_panel,
    dashboard_panel,
    emission_share_panel,
    gdp_per_capita,
    history_by_group,
    history_by_sector,
    instrument_dim,
    price_panel,
    read_dashboard,
    revenue_panel,
)
from panelkit.session import durable

TAIL = (2001, [2002, 2003])
HISTORY = list(range(1993, 2004))
EXCLUDED = ["NATION_4", "NATION_9"]
SUMS = ["n", "qty", "tax", "ext"]


def instrument_lines(spark, sf_dir):
    """Sums per instrument and year, one row per supplier before the join."""
    per_supplier = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", "l_returnflag", "l_linestatus", F.year("l_shipdate").alias("period"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("l_quantity").alias("qty"),
            F.sum(F.rint(F.col("l_tax") * 100).cast("long")).alias("tax"),
            F.sum("l_extendedprice").alias("ext"),
        )
    )
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    per_nation = (
        per_supplier.join(supplier, per_supplier.l_suppkey == supplier.s_suppkey)
        .groupBy("s_nationkey", "l_returnflag", "l_linestatus", "period")
        .agg(*[F.sum(c).alias(c) for c in SUMS])
    )
    nation = nations(spark, sf_dir)
    own = per_nation.join(nation, per_nation.s_nationkey == nation.n_nationkey).select(
        F.concat_ws("_", "l_returnflag", "n_nationkey", "l_linestatus").alias("unique_id"),
        F.col("l_returnflag").alias("f"),
        F.col("l_linestatus").alias("s"),
        F.col("n_nationkey").alias("nk"),
        F.col("n_name").alias("region"),
        "r_name",
        "period",
        *SUMS,
    )
    # the bloc's rows come from the same pass: each permit row also counts for it
    is_permit = (F.col("f") == "N") & (F.col("s") == "F") & (F.col("r_name") == "EUROPE")
    bloc_id = F.lit(K.BLOC_ID)
    ids = F.when(is_permit, F.array(F.col("unique_id"), bloc_id)).otherwise(
        F.array(F.col("unique_id"))
    )
    each = own.withColumn("unique_id", F.explode(ids))
    of_bloc = F.col("unique_id") == bloc_id
    return (
        each.withColumns(
            {
                "nk": F.when(~of_bloc, F.col("nk")),
                "region": F.when(of_bloc, "EU").otherwise(F.col("region")),
            }
        )
        .groupBy("unique_id", "f", "s", "nk", "region", "period")
        .agg(*[F.sum(c).alias(c) for c in SUMS])
    )


def instrument_ids(spark, sf_dir):
    """Every instrument: nation by flag by status, and the bloc's own."""
    own = (
        table(spark, sf_dir, "nation")
        .withColumn("f", F.explode(F.array(*[F.lit(f) for f in "ANR"])))
        .withColumn("s", F.explode(F.array(*[F.lit(s) for s in "FO"])))
        .select(
            F.concat_ws("_", "f", "n_nationkey", "s").alias("unique_id"),
            F.col("n_name").alias("region"),
            F.col("n_nationkey").alias("nk"),
            "f",
            "s",
        )
    )
    bloc = spark.range(1).select(
        F.lit(K.BLOC_ID).alias("unique_id"),
        F.lit("EU").alias("region"),
        F.lit(None).cast("int").alias("nk"),
        F.lit("N").alias("f"),
        F.lit("F").alias("s"),
    )
    return own.unionByName(bloc)


def _name():
    return F.concat(F.lit("Initiative "), F.col("unique_id"))


def info_sheet(ids):
    even = F.col("nk") % 2 == 0
    return ids.select(
        "unique_id",
        _name().alias("instrument_name"),
        F.when(F.col("f") == "A", "Carbon tax")
        .when(F.col("f") == "R", "Carbon Tax")
        .when(F.col("nk") >= 20, "Undecided")
        .otherwise("ETS")
        .alias("type"),
        F.when(F.col("s") == "F", "Implemented")
        .when(even, "Abolished")
        .otherwise("Under consideration")
        .alias("status"),
        *[c for c in ids.columns if c in ("share_of_jurisdiction_emissions_covered", "price_on_1_april")],
    )


def with_texts(ids, lines):
    """Add the two text cells, written from the instruments' totals."""
    totals = lines.groupBy("unique_id").agg(
        F.sum("n").alias("n"), F.sum("qty").cast("long").alias("qty")
    )
    share = F.concat(
        (F.col("n") % 100).cast("string"),
        F.lit(".5% of jurisdiction emissions, 1% of global emissions"),
    )
    price = F.concat(
        F.lit("US$ "),
        F.format_number("qty", 0),
        F.lit(" (EUR "),
        F.col("n").cast("string"),
        F.lit(")"),
    )
    return ids.join(totals, "unique_id").withColumns(
        {
            "share_of_jurisdiction_emissions_covered": F.when(F.col("f") == "R", "n/a").otherwise(
                share
            ),
            "price_on_1_april": F.when(F.col("s") == "O", "not set").otherwise(price),
        }
    )


def dashboard(spark, sf_dir, texts: bool = False, emissions: bool = True) -> Dashboard:
    """The inputs; without ``emissions`` there is no history."""
    # the facts are read once each; the sheets are made from these sums
    lines = durable(instrument_lines(spark, sf_dir))
    history = history_panel(spark, sf_dir) if emissions else None
    of_bloc = F.col("unique_id") == K.BLOC_ID
    ids = instrument_ids(spark, sf_dir)
    regions = ids.select(
        "unique_id",
        "region",
        F.when(of_bloc, "region")
        .when(F.col("nk") % 7 == 6, "within_country")
        .otherwise("country")
        .alias("region_type"),
    )
    sectors = ids.select(
        "unique_id",
        F.when(of_bloc | (F.col("f") == "A"), "bulk")
        .when(F.col("f") == "R", "diffuse")
        .when(F.col("nk") % 2 == 0, "all")
        .alias("sector_group"),
    )
    price = lines.select(
        "unique_id",
        F.when(of_bloc, "Bloc").when(F.col("nk") < 12, "High").otherwise("Low").alias("income_group"),
        "period",
        F.when(F.col("qty") / F.col("n") >= 25, F.col("tax") / F.col("n")).alias("value"),
    )
    revenue = lines.select(
        _name().alias("instrument_name"), "period", F.col("ext").alias("value")
    )
    total = lines.filter(~of_bloc).groupBy("period").agg(F.sum("n").alias("total"))
    share = lines.join(total, "period").select(
        _name().alias("name_of_the_initiative"),
        "period",
        (0.5 * F.col("n") / F.col("total")).alias("value"),
    )
    return Dashboard(
        info=info_sheet(with_texts(ids, lines) if texts else ids),
        price=widen_years(price, ["unique_id", "income_group"], YEARS),
        revenue=widen_years(revenue, ["instrument_name"], YEARS),
        emissions=widen_years(share, ["name_of_the_initiative"], YEARS),
        region_map=regions,
        sector_map=sectors,
        history=history,
        members=bloc_members(spark, sf_dir),
        tail=TAIL,
    )


# --- the same in SQL ---------------------------------------------------------

SHEET = f"""lines AS (
  SELECT n_nationkey AS nk, n_name, n_regionkey AS rk, l_returnflag AS f, l_linestatus AS s,
         CAST(year(l_shipdate) AS INTEGER) AS period, COUNT(*) AS n, SUM(l_quantity) AS qty,
         SUM(CAST(round(l_tax * 100) AS BIGINT)) AS tax, SUM(l_extendedprice) AS ext
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY 1, 2, 3, 4, 5, 6),
member AS (SELECT n_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE'),
sheet AS (
  SELECT f || '_' || nk || '_' || s AS unique_id, period, n, qty, tax, ext FROM lines
  UNION ALL
  SELECT 'ETS_EU', period, SUM(n), SUM(qty), SUM(tax), SUM(ext) FROM lines
  WHERE f = 'N' AND s = 'F' AND n_name IN (SELECT name FROM member) GROUP BY period),
inst AS (
  SELECT f || '_' || nk || '_' || s AS unique_id, n_name AS region,
         CASE WHEN nk % 7 = 6 THEN 'within_country' ELSE 'country' END AS region_type,
         CASE WHEN f IN ('A', 'R') THEN 'carbon_tax' WHEN nk >= 20 THEN NULL ELSE 'ets' END AS type,
         CASE WHEN f = 'A' THEN 'Carbon tax' WHEN f = 'R' THEN 'Carbon Tax' WHEN nk >= 20 THEN 'Undecided' ELSE 'ETS' END AS raw_type,
         CASE WHEN s = 'F' THEN 'implemented' WHEN nk % 2 = 0 THEN 'abolished' ELSE 'under_consideration' END AS status,
         CASE WHEN s = 'F' THEN 'Implemented' WHEN nk % 2 = 0 THEN 'Abolished' ELSE 'Under consideration' END AS raw_status,
         CASE WHEN f = 'A' THEN 'bulk' WHEN f = 'R' THEN 'diffuse' WHEN nk % 2 = 0 THEN 'all' ELSE '' END AS sector_group,
         CASE WHEN nk < 12 THEN 'High' ELSE 'Low' END AS income_group, f, s
  FROM (SELECT n_nationkey AS nk, n_name, f, s FROM nation CROSS JOIN (VALUES ('A'), ('N'), ('R')) x(f) CROSS JOIN (VALUES ('F'), ('O')) z(s)) t
  UNION ALL
  SELECT 'ETS_EU', 'EU', 'region', 'ets', 'ETS', 'implemented', 'Implemented', 'bulk', 'Bloc', 'N', 'F'),
price AS (
  SELECT i.*, period, tax / n AS value FROM sheet JOIN inst i ON i.unique_id = sheet.unique_id WHERE qty / n >= 25),
share AS (
  SELECT i.*, sheet.period, 0.5 * n / t.total AS value FROM sheet JOIN inst i ON i.unique_id = sheet.unique_id
  JOIN (SELECT period, SUM(n) AS total FROM lines GROUP BY period) t ON t.period = sheet.period),
{H.strip()},
tail AS (
  SELECT * FROM hist
  UNION ALL SELECT region, CAST(unnest([2002, 2003]) AS INTEGER), variable, pollutant, value FROM hist WHERE period = 2001),
covered AS (
  SELECT share.* REPLACE (share.value * g.value AS value)
  FROM share LEFT JOIN (SELECT period, SUM(value) AS value FROM tail GROUP BY period) g ON g.period = share.period)"""

TAGS = "unique_id, region, region_type, type, status, sector_group, period"


def _net(source: str) -> str:
    return f"""expanded AS (
  SELECT {TAGS}, value FROM {source} WHERE region_type = 'country'
  UNION ALL
  SELECT unique_id, name, 'country', type, status, sector_group, period, value
  FROM {source} CROSS JOIN member WHERE unique_id = 'ETS_EU'),
marked AS (
  SELECT *, region IN (SELECT name FROM member) AND type = 'carbon_tax' AND status = 'implemented'
            AND sector_group = 'bulk' AS is_own FROM expanded),
netted AS (
  SELECT region, type, status, sector_group, period, value FROM marked WHERE NOT is_own
  UNION ALL
  SELECT m.region, m.type, m.status, m.sector_group, m.period, m.value - b.value
  FROM marked m JOIN marked b ON b.region = m.region AND b.period = m.period AND b.unique_id = 'ETS_EU'
  WHERE m.is_own AND m.value - b.value > 0)"""


ALLOCATED = """bulk AS (
  SELECT region, period, SUM(value) AS value FROM tail
  WHERE variable IN ('Industrial Combustion', 'Power Industry', 'Processes', 'Fuel Exploitation')
    AND region IN (SELECT name FROM member) GROUP BY 1, 2),
bloc_share AS (
  SELECT c.period, c.value / b.total AS share FROM covered c
  JOIN (SELECT period, SUM(value) AS total FROM bulk GROUP BY period) b ON b.period = c.period
  WHERE c.unique_id = 'ETS_EU'),
allocated AS (
  SELECT region, type, status, sector_group, period, value FROM covered WHERE region_type = 'country'
  UNION ALL
  SELECT bulk.region, 'ets', 'implemented', 'bulk', bulk.period, COALESCE(bulk.value * share, 0)
  FROM bulk LEFT JOIN bloc_share ON bloc_share.period = bulk.period)"""

FINAL = f"""full_history AS (
  SELECT * FROM hist UNION ALL
  SELECT region, CAST(y AS INTEGER), variable, pollutant, value
  FROM hist CROSS JOIN (SELECT unnest(range(1993, 2004)) AS y)
  WHERE period = (SELECT MAX(period) FROM hist) AND y NOT IN (SELECT period FROM hist)),
hg AS (
  SELECT region, period, COALESCE(SUM(CASE WHEN g = 'bulk' THEN value END), 0) AS bulk,
         COALESCE(SUM(CASE WHEN g = 'diffuse' THEN value END), 0) AS diffuse
  FROM (SELECT *, CASE {SQL_GROUPS} END AS g FROM full_history) t GROUP BY 1, 2),
cells AS (
  SELECT n_name AS region, y.period, COALESCE(h.bulk, 0) AS hb, COALESCE(h.diffuse, 0) AS hd,
         COALESCE(c.everything, 0) AS c_all, COALESCE(c.bulk, 0) AS cb, COALESCE(c.diffuse, 0) AS cd,
         COALESCE(p.everything, 0) AS p_all, COALESCE(p.bulk, 0) AS pb, COALESCE(p.diffuse, 0) AS pd,
         y.period IN (SELECT period FROM netted) AS has_price
  FROM nation CROSS JOIN (SELECT DISTINCT period FROM allocated) y
  LEFT JOIN hg h ON h.region = n_name AND h.period = y.period
  LEFT JOIN (
    SELECT region, period, SUM(CASE WHEN sector_group = 'all' THEN value END) AS everything,
           SUM(CASE WHEN sector_group = 'bulk' THEN value END) AS bulk,
           SUM(CASE WHEN sector_group = 'diffuse' THEN value END) AS diffuse
    FROM allocated WHERE status = 'implemented' GROUP BY 1, 2) c ON c.region = n_name AND c.period = y.period
  LEFT JOIN (
    SELECT region, period, SUM(CASE WHEN sector_group = 'all' THEN value END) AS everything,
           SUM(CASE WHEN sector_group = 'bulk' THEN value END) AS bulk,
           SUM(CASE WHEN sector_group = 'diffuse' THEN value END) AS diffuse
    FROM netted WHERE status = 'implemented' GROUP BY 1, 2) p ON p.region = n_name AND p.period = y.period),
own AS (
  SELECT *, CASE WHEN region IN ('NATION_4', 'NATION_9') OR hb + hd = 0 THEN 0 ELSE cb + c_all * (hb / (hb + hd)) END AS ob,
         CASE WHEN region IN ('NATION_4', 'NATION_9') OR hb + hd = 0 THEN 0 ELSE cd + c_all * (hd / (hb + hd)) END AS od
  FROM cells),
capped AS (
  SELECT *, LEAST(ob - GREATEST(ob - hb, 0) + GREATEST(od - hd, 0), hb) AS eb,
         LEAST(od - GREATEST(od - hd, 0) + GREATEST(ob - hb, 0), hd) AS ed FROM own),
shared AS (
  SELECT *, CASE WHEN hb = 0 THEN 0 ELSE eb / hb END AS sb, CASE WHEN hd = 0 THEN 0 ELSE ed / hd END AS sd FROM capped)"""

BOARD = f"WITH {SHEET}, {_net('price')}, {ALLOCATED}, {FINAL}"


def _two(bulk: str, diffuse: str, where: str = "TRUE", weight: bool = True, places: int = 6) -> str:
    w_b = ", ROUND(hb, 4) AS weight" if weight else ""
    w_d = ", ROUND(hd, 4) AS weight" if weight else ""
    return f"""SELECT region, period, 'bulk' AS sector_group, ROUND({bulk}, {places}) AS value{w_b} FROM shared WHERE {where}
UNION ALL SELECT region, period, 'diffuse', ROUND({diffuse}, {places}) AS value{w_d} FROM shared WHERE {where}"""


# --- queries -------------------------------------------------------------------


@query(f"""WITH {SHEET}
SELECT unique_id, 'Initiative ' || unique_id AS instrument_name, region, region_type, type, status, sector_group,
  CASE WHEN unique_id IN (SELECT unique_id FROM sheet) THEN income_group END AS income_group FROM inst""", name="instrument_dim")
def instrument_dimension(spark, sf_dir):
    return instrument_dim(dashboard(spark, sf_dir, emissions=False)).select(
        *["unique_id", "instrument_name", "region", "region_type"],
        *["type", "status", "sector_group", "income_group"],
    )


@query(f"""WITH {SHEET}
SELECT i.unique_id, region, region_type, type, status, ROUND((t.n % 100 + 0.5) / 100, 8) AS emissions_coverage
FROM inst i JOIN (SELECT unique_id, SUM(n) AS n FROM sheet GROUP BY 1) t ON t.unique_id = i.unique_id WHERE f <> 'R'""", name="coverage_shares")
def coverage_from_text(spark, sf_dir):
    return rounded(coverage_shares(dashboard(spark, sf_dir, texts=True, emissions=False)), "emissions_coverage")


@query(f"""WITH {SHEET}
SELECT i.unique_id, region, region_type, raw_type AS type, raw_status AS status, sector_group,
       format('{{:,}}', CAST(t.qty AS BIGINT)) AS price_on_1_april_US, CAST(t.qty AS DOUBLE) AS price_on_1_april
FROM inst i JOIN (SELECT unique_id, SUM(qty) AS qty FROM sheet GROUP BY 1) t ON t.unique_id = i.unique_id WHERE s <> 'O'""", name="april_price")
def april_price_from_text(spark, sf_dir):
    return rounded(april_prices(dashboard(spark, sf_dir, texts=True, emissions=False)), "price_on_1_april")


@query(f"WITH {SHEET} SELECT {TAGS}, ROUND(value, 8) AS value FROM price", name="price_panel")
def price_by_instrument(spark, sf_dir):
    return rounded(price_panel(dashboard(spark, sf_dir, emissions=False)))


@query(f"""WITH {SHEET}
SELECT i.unique_id, region, region_type, type, status, sector_group, period, ROUND(ext, 4) AS value
FROM sheet JOIN inst i ON i.unique_id = sheet.unique_id""", name="revenue_panel")
def revenue_by_instrument(spark, sf_dir):
    return rounded(revenue_panel(dashboard(spark, sf_dir, emissions=False)), places=4)


@query(f"WITH {SHEET} SELECT {TAGS}, ROUND(value, 8) AS value FROM share")
def share_panel_by_name(spark, sf_dir):
    return rounded(emission_share_panel(dashboard(spark, sf_dir, emissions=False)))


@query(f"WITH {SHEET} SELECT {TAGS}, ROUND(value, 2) AS value FROM covered")
def covered_by_instrument(spark, sf_dir):
    return rounded(covered_emissions_panel(dashboard(spark, sf_dir)), places=2)


@query(f"WITH {SHEET} SELECT region, period, variable, ROUND(SUM(value), 4) AS value FROM tail GROUP BY 1, 2, 3")
def history_with_tail_years(spark, sf_dir):
    return rounded(history_by_sector(dashboard(spark, sf_dir)), places=4)


@query(f"{BOARD} SELECT region, period, ROUND(bulk, 4) AS hist_bulk, ROUND(diffuse, 4) AS hist_diffuse FROM hg")
def history_per_group(spark, sf_dir):
    out = history_by_group(dashboard(spark, sf_dir), HISTORY)
    return rounded(out, "hist_bulk", "hist_diffuse", places=4)


@query(f"""WITH {SHEET}, {_net("price")}
SELECT region, type, status, sector_group, period, ROUND(value, 8) AS value FROM netted""")
def dashboard_price(spark, sf_dir):
    return rounded(read_dashboard(dashboard(spark, sf_dir, emissions=False), "price"))


@query(f"""WITH {SHEET}, money AS (
  SELECT i.*, period, ext AS value FROM sheet JOIN inst i ON i.unique_id = sheet.unique_id),
{_net("money")}
SELECT region, type, status, sector_group, period, ROUND(value, 4) AS value FROM netted""")
def dashboard_revenue(spark, sf_dir):
    return rounded(read_dashboard(dashboard(spark, sf_dir, emissions=False), "revenue"), places=4)


@query(f"""WITH {SHEET}, {ALLOCATED}
SELECT region, type, status, sector_group, period, ROUND(value, 4) AS value FROM allocated""")
def dashboard_emissions_covered(spark, sf_dir):
    return rounded(read_dashboard(dashboard(spark, sf_dir), "emissionsCovered"), places=4)


@query(f"""WITH {SHEET}, {_net("price")}
SELECT n_name AS region, k.type, k.status, k.sector_group, y.period, ROUND(COALESCE(n.value, 0), 8) AS value
FROM (SELECT DISTINCT type, status, sector_group FROM netted) k CROSS JOIN (SELECT DISTINCT period FROM netted) y CROSS JOIN nation
LEFT JOIN netted n ON n.region = n_name AND n.period = y.period AND n.type IS NOT DISTINCT FROM k.type
  AND n.status IS NOT DISTINCT FROM k.status AND n.sector_group IS NOT DISTINCT FROM k.sector_group""")
def price_on_country_list(spark, sf_dir):
    board = dashboard(spark, sf_dir, emissions=False)
    return rounded(dashboard_panel(board, all_nations(spark, sf_dir), "price", cut_lineage=True))


@query(f"""WITH {H.strip()},
gdp AS (SELECT region, period, SUM(value) AS value FROM hist GROUP BY 1, 2),
heads AS (
  SELECT n_name AS region, CAST(year(l_shipdate) AS INTEGER) AS period, SUM(l_extendedprice) AS value
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2),
ratio AS (SELECT gdp.region, gdp.period, gdp.value / heads.value AS value
          FROM gdp JOIN heads ON heads.region = gdp.region AND heads.period = gdp.period)
SELECT region, period, ROUND(value, 8) AS value FROM ratio
UNION ALL SELECT region, CAST(unnest([2002, 2003]) AS INTEGER), ROUND(value, 8) FROM ratio WHERE period = 2001""")
def gdp_per_capita_with_tail(spark, sf_dir):
    cell = ["region", "period"]
    gdp = total_by(history_panel(spark, sf_dir), cell)
    lines = instrument_lines(spark, sf_dir).filter(F.col("unique_id") != K.BLOC_ID)
    heads = lines.groupBy(*cell).agg(F.sum("ext").alias("value"))
    return rounded(gdp_per_capita(gdp, heads, TAIL))


def _carbon(spark, sf_dir, subtype):
    return _result(spark, sf_dir, subtype).data


def _result(spark, sf_dir, subtype):
    return carbon_price(
        spark,
        dashboard(spark, sf_dir),
        all_nations(spark, sf_dir),
        subtype,
        HISTORY,
        EXCLUDED,
        cut_lineage=True,
    )


@query(f"{BOARD} {_two('eb', 'ed', weight=False, places=2)}")
def carbon_emissions_covered(spark, sf_dir):
    return rounded(_carbon(spark, sf_dir, "emissionsCovered"), places=2)


def _weighted(df):
    return rounded(rounded(df, places=6), "weight", places=4)


@query(f"{BOARD} {_two('sb', 'sd')}")
def carbon_share_covered(spark, sf_dir):
    return _weighted(_carbon(spark, sf_dir, "shareEmissionsCovered"))


@query(f"{BOARD} {_two('pb + p_all', 'pd + p_all', 'has_price')}")
def carbon_price_by_group(spark, sf_dir):
    return _weighted(_carbon(spark, sf_dir, "carbonPrice"))


@query(f"{BOARD} {_two('(pb + p_all) * sb', '(pd + p_all) * sd', 'has_price')}")
def effective_price(spark, sf_dir):
    return _weighted(_carbon(spark, sf_dir, "effectivePrice"))


@query(f"""{BOARD}, eff AS (
  SELECT region, period, 'bulk' AS sector_group, (pb + p_all) * sb AS value, hb AS weight FROM shared WHERE has_price
  UNION ALL SELECT region, period, 'diffuse', (pd + p_all) * sd, hd FROM shared WHERE has_price)
SELECT r_name AS region, period, sector_group, ROUND(SUM(value * weight) / SUM(weight), 6) AS value, ROUND(SUM(weight), 4) AS weight
FROM eff JOIN nation ON n_name = eff.region JOIN region r ON r_regionkey = n_regionkey GROUP BY 1, 2, 3""")
def effective_price_by_region(spark, sf_dir):
    result = _result(spark, sf_dir, "effectivePrice")
    return _weighted(aggregate_result(result, region_map(spark, sf_dir)).data)
