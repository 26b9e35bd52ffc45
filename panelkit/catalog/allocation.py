"""Moving amounts between sector groups and between a bloc and its members."""

from pyspark.sql import functions as F

from panelkit import constants as K
from panelkit.catalog.registry import query, rounded
from panelkit.catalog.tables import (
    H,
    PI,
    PO,
    bloc_members,
    history_panel,
    instruments_panel,
    orders_panel,
)
from panelkit.functions import ratio_or_zero
from panelkit.operators.complete import flag_on_axis
from panelkit.operators.aggregate import sum_out
from panelkit.operators.allocate import (
    allocate_group_total,
    expand_group,
    fold_group,
    gather_groups,
    group_shares,
    map_groups,
    net_of_group,
    reallocate_excess,
    split_by_share,
    spread_groups,
    zero_out,
)
from panelkit.operators.joins import combine
from panelkit.session import durable

CELL = ["region", "period"]
GROUPS = ["bulk", "diffuse"]
SQL_GROUPS = "\n".join(
    f"WHEN variable IN ({', '.join(repr(m) for m in members)}) THEN '{g}'"
    for g, members in K.SECTOR_GROUPS.items()
)

# historical emissions per sector group, one column each
HG = f"""{H}, hg AS (
  SELECT region, period,
         COALESCE(SUM(CASE WHEN grp = 'bulk' THEN value END), 0) AS bulk,
         COALESCE(SUM(CASE WHEN grp = 'diffuse' THEN value END), 0) AS diffuse,
         COALESCE(SUM(CASE WHEN grp = 'bunkers' THEN value END), 0) AS bunkers
  FROM (SELECT *, CASE {SQL_GROUPS} END AS grp FROM hist) t GROUP BY 1, 2)"""

# covered emissions: part of the historical ones, by percent of all instruments; those of no group cover all
COVERED = """cov AS (
  SELECT h.region, h.period,
         COALESCE(SUM(CASE WHEN sector_group IN ('bulk', 'diffuse') THEN NULL ELSE value END), 0)
           * 0.0051440329 * (bulk + diffuse) AS everything,
         COALESCE(SUM(CASE WHEN sector_group = 'bulk' THEN value END), 0) * 0.0137174211 * bulk AS bulk,
         COALESCE(SUM(CASE WHEN sector_group = 'diffuse' THEN value END), 0) * 0.0017146776 * diffuse AS diffuse
  FROM hg h JOIN pi ON pi.region = h.region AND pi.period = h.period
  GROUP BY h.region, h.period, h.bulk, h.diffuse)"""

LONG = """SELECT region, period, 'bulk' AS sector_group, ROUND({bulk}, {places}) AS value FROM {source}
UNION ALL SELECT region, period, 'diffuse', ROUND({diffuse}, {places}) FROM {source}"""


def history_groups(spark, sf_dir):
    return map_groups(history_panel(spark, sf_dir), CELL, K.SECTOR_GROUPS, "variable")


def covered_and_history(spark, sf_dir):
    """Covered emissions and, as a table of its own, the history they are part of."""
    history = durable(history_groups(spark, sf_dir))
    hist = spread_groups(history, CELL, GROUPS)
    group = F.col("sector_group")
    percent = instruments_panel(spark, sf_dir).withColumn(
        "sector_group", F.when(group.isin(*GROUPS), group).otherwise("all")
    )
    base = (
        F.when(group == "all", 0.0051440329 * (F.col("bulk") + F.col("diffuse")))
        .when(group == "bulk", 0.0137174211 * F.col("bulk"))
        .otherwise(0.0017146776 * F.col("diffuse"))
    )
    covered = percent.join(hist, CELL).select(
        *CELL, "sector_group", (F.col("value") * base).alias("value")
    )
    return covered, history


@query(f"""WITH {HG}
SELECT region, period, 'bulk' AS sector_group, ROUND(bulk, 4) AS value FROM hg
UNION ALL SELECT region, period, 'diffuse', ROUND(diffuse, 4) FROM hg
UNION ALL SELECT region, period, 'bunkers', ROUND(bunkers, 4) FROM hg""")
def sector_rollup(spark, sf_dir):
    return rounded(history_groups(spark, sf_dir), places=4)


@query(f"""WITH {HG}
{LONG.format(places=8, source="hg", bulk="bulk / (bulk + diffuse)", diffuse="diffuse / (bulk + diffuse)")}""")
def sector_rollup_shares(spark, sf_dir):
    return rounded(group_shares(history_groups(spark, sf_dir), CELL, GROUPS))


@query(f"""WITH {PI}, p AS (
  SELECT region, period, sector_group, SUM(value) AS value FROM pi WHERE status = 'implemented' GROUP BY 1, 2, 3)
SELECT region, period, g AS sector_group, ROUND(COALESCE(SUM(value), 0), 8) AS value FROM (
  SELECT region, period, sector_group AS g, value FROM p WHERE sector_group IN ('bulk', 'diffuse', 'other')
  UNION ALL SELECT region, period, unnest(['bulk', 'diffuse']), value FROM p WHERE sector_group = 'all')
GROUP BY 1, 2, 3""")
def fold_all_group(spark, sf_dir):
    pi = instruments_panel(spark, sf_dir, statuses=["implemented"])
    return rounded(fold_group(pi, CELL, "all", GROUPS, keep=["other"]))


@query(f"""WITH {HG}, {PI}, {COVERED}, s AS (
  SELECT cov.region, cov.period, cov.bulk + everything * hg.bulk / (hg.bulk + hg.diffuse) AS bulk,
         cov.diffuse + everything * hg.diffuse / (hg.bulk + hg.diffuse) AS diffuse
  FROM cov JOIN hg ON hg.region = cov.region AND hg.period = cov.period)
{LONG.format(places=2, source="s", bulk="bulk", diffuse="diffuse")}""", name="split_by_share")
def split_all_by_share(spark, sf_dir):
    covered, hist = covered_and_history(spark, sf_dir)
    return rounded(split_by_share(covered, hist, CELL, "all", GROUPS), places=2)


MOVED = """moved AS (
  SELECT cov.region, cov.period, hg.bulk AS hb, hg.diffuse AS hd,
         cov.bulk - GREATEST(cov.bulk - hg.bulk, 0) + GREATEST(cov.diffuse - hg.diffuse, 0) AS bulk,
         cov.diffuse - GREATEST(cov.diffuse - hg.diffuse, 0) + GREATEST(cov.bulk - hg.bulk, 0) AS diffuse
  FROM (SELECT region, period, bulk * 3 AS bulk, diffuse * 3 AS diffuse FROM cov) cov
  JOIN hg ON hg.region = cov.region AND hg.period = cov.period)"""


def _tripled(spark, sf_dir):
    covered, hist = covered_and_history(spark, sf_dir)
    return covered.withColumn("value", F.col("value") * 3), hist


@query(f"""WITH {HG}, {PI}, {COVERED}, {MOVED}
{LONG.format(places=2, source="moved", bulk="bulk", diffuse="diffuse")}""", name="reallocate_excess")
def reallocate_excess_groups(spark, sf_dir):
    out = reallocate_excess(*_tripled(spark, sf_dir), CELL, GROUPS)
    return rounded(out, places=2)


@query(f"""WITH {HG}, {PI}, {COVERED}, {MOVED}
{LONG.format(places=2, source="moved", bulk="LEAST(bulk, hb)", diffuse="LEAST(diffuse, hd)")}""")
def reallocate_excess_cap(spark, sf_dir):
    out = reallocate_excess(*_tripled(spark, sf_dir), CELL, GROUPS, capped=True)
    return rounded(out, places=2)


@query(f"""WITH {HG}, {PI}, {COVERED}, s AS (
  SELECT cov.region, cov.period, CASE WHEN hg.bulk = 0 THEN 0 ELSE cov.bulk / hg.bulk END AS bulk,
         CASE WHEN hg.diffuse = 0 THEN 0 ELSE cov.diffuse / hg.diffuse END AS diffuse
  FROM cov JOIN hg ON hg.region = cov.region AND hg.period = cov.period)
{LONG.format(places=6, source="s", bulk="bulk", diffuse="diffuse")}""")
def coverage_share(spark, sf_dir):
    covered, hist = covered_and_history(spark, sf_dir)
    wide = spread_groups(covered, CELL, GROUPS)
    covered = gather_groups(wide, CELL, {"value": {g: F.col(g) for g in GROUPS}})
    keys = [*CELL, "sector_group"]
    return rounded(combine(covered, hist, ratio_or_zero, keys).select(*keys, "value"), places=6)


# the bloc: sum of the implemented permits of the European nations
BLOC = f"""{PI}, member AS (
  SELECT n_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE'),
own AS (SELECT 'own' AS unique_id, region, type, status, sector_group, period, value FROM pi),
bloc AS (
  SELECT 'bloc' AS unique_id, 'EU' AS region, type, status, sector_group, period, SUM(value) / 5 AS value
  FROM pi WHERE type = 'ets' AND status = 'implemented' AND region IN (SELECT name FROM member) GROUP BY 2, 3, 4, 5, 6),
expanded AS (
  SELECT * FROM own
  UNION ALL SELECT unique_id, name, type, status, sector_group, period, value FROM bloc CROSS JOIN member)"""


def with_bloc(spark, sf_dir):
    """The instruments and the bloc's own, in one pass: a member's permit counts for both."""
    pi = flag_on_axis(instruments_panel(spark, sf_dir), "region", bloc_members(spark, sf_dir), "member")
    is_permit = (F.col("type") == "ets") & (F.col("status") == "implemented") & F.col("member")
    ids = F.when(is_permit, F.array(F.lit("own"), F.lit("bloc"))).otherwise(F.array(F.lit("own")))
    of_bloc = F.col("unique_id") == "bloc"
    return durable(
        pi.withColumn("unique_id", F.explode(ids))
        .withColumns(
            {
                "region": F.when(of_bloc, "EU").otherwise(F.col("region")),
                "value": F.when(of_bloc, F.col("value") / 5).otherwise(F.col("value")),
            }
        )
        .groupBy("unique_id", "region", "type", "status", "sector_group", "period")
        .agg(F.sum("value").alias("value"))
    )


def expanded(spark, sf_dir):
    is_bloc = F.col("unique_id") == "bloc"
    return expand_group(
        with_bloc(spark, sf_dir), is_bloc, bloc_members(spark, sf_dir), keep=~is_bloc
    )


@query(f"WITH {BLOC} SELECT unique_id, region, type, status, sector_group, period, ROUND(value, 8) AS value FROM expanded")
def expand_bloc(spark, sf_dir):
    return rounded(expanded(spark, sf_dir))


@query(f"""WITH {BLOC}, price AS (
  SELECT region, period, value FROM expanded WHERE unique_id = 'bloc' AND sector_group = 'bulk'),
marked AS (
  SELECT *, region IN (SELECT name FROM member) AND type = 'carbon_tax'
            AND status = 'implemented' AND sector_group = 'bulk' AS is_own FROM expanded)
SELECT unique_id, region, type, status, sector_group, period, ROUND(value, 8) AS value
FROM marked WHERE NOT is_own
UNION ALL
SELECT m.unique_id, m.region, m.type, m.status, m.sector_group, m.period, ROUND(m.value - price.value, 8)
FROM marked m JOIN price ON price.region = m.region AND price.period = m.period
WHERE m.is_own AND m.value - price.value > 0""")
def net_of_bloc(spark, sf_dir):
    rows = expanded(spark, sf_dir)
    price = rows.filter((F.col("unique_id") == "bloc") & (F.col("sector_group") == "bulk"))
    rows = flag_on_axis(rows, "region", bloc_members(spark, sf_dir), "member")
    implemented = (F.col("status") == "implemented") & (F.col("sector_group") == "bulk")
    out = net_of_group(
        rows,
        own=F.col("member") & (F.col("type") == "carbon_tax") & implemented,
        group=price,
        keys=CELL,
    )
    return rounded(out.drop("member"))


@query(f"""WITH {PO}, member AS (
  SELECT n_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE'),
base AS (SELECT region, period, SUM(value) AS value FROM po WHERE region IN (SELECT name FROM member) GROUP BY 1, 2),
total AS (SELECT period, SUM(value) AS value FROM po WHERE category = 'MACHINERY' GROUP BY 1),
share AS (SELECT t.period, t.value / SUM(b.value) AS share FROM total t JOIN base b ON b.period = t.period GROUP BY t.period, t.value)
SELECT base.region, base.period, ROUND(COALESCE(base.value * share.share, 0), 4) AS value
FROM base LEFT JOIN share ON share.period = base.period""")
def allocate_bloc_total(spark, sf_dir):
    po = orders_panel(spark, sf_dir)
    totals = po.filter(F.col("category") == "MACHINERY").groupBy("period").agg(F.sum("value").alias("value"))
    out = allocate_group_total(totals, sum_out(po, ["category"]), bloc_members(spark, sf_dir))
    return rounded(out, places=4)


@query(f"""WITH {PO}
SELECT region, period, category, ROUND(CASE WHEN region IN ('NATION_3', 'NATION_7') THEN 0 ELSE value END, 4) AS value FROM po""")
def zero_out_exclusions(spark, sf_dir):
    return rounded(zero_out(orders_panel(spark, sf_dir), ["NATION_3", "NATION_7"]), places=4)
