"""Completing panels: missing years, missing entities, missing combinations.

An axis is a list of labels or a table with one column, of any length. A grid joins the
distinct keys to the axis in two dimensions: the axis is packed into chunks of about a thousand
labels, the keys are dealt into buckets, and each bucket meets each chunk once. There are about
twice as many such meetings as shuffle partitions, so no cross join is planned, and neither few
keys nor a short axis put the grid into few tasks, whether Spark broadcasts the axis or not.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.functions import member_of
from panelkit.operators.joins import null_safe_join

CHUNK = 1_000  # labels of an axis that one key asks for at a time

Axis = Sequence | DataFrame


def axis_of(df: DataFrame, column: str) -> DataFrame:
    """The distinct non-NULL values of a column, as an axis."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct()


def axis_table(spark: SparkSession, axis: Axis, name: str) -> DataFrame:
    """An axis as a table with one column of the given name and no label twice."""
    if isinstance(axis, DataFrame):
        return axis.toDF(name).filter(F.col(name).isNotNull()).distinct()
    labels = list(dict.fromkeys(axis))
    number = all(isinstance(v, int) for v in labels) and labels
    kind = T.IntegerType() if number else T.StringType()
    return spark.createDataFrame([(v,) for v in labels], T.StructType([T.StructField(name, kind)]))


def on_axis(df: DataFrame, column: str, axis: Axis) -> DataFrame:
    """Rows whose ``column`` lies on the axis."""
    if not isinstance(axis, DataFrame):
        return df.filter(F.col(column).isin(list(axis)))
    listed = axis.toDF("__on_axis").distinct()
    return df.join(listed, F.col(column) == F.col("__on_axis"), "left_semi")


def flag_on_axis(df: DataFrame, column: str, axis: Axis, flag: str) -> DataFrame:
    """Add whether ``column`` lies on the axis; false for NULL."""
    if not isinstance(axis, DataFrame):
        return df.withColumn(flag, member_of(F.col(column), list(axis)))
    listed = axis.toDF("__on_axis").distinct()
    joined = df.join(listed, F.col(column) == F.col("__on_axis"), "left")
    return joined.withColumn(flag, F.col("__on_axis").isNotNull()).drop("__on_axis")


def common_axis(spark: SparkSession, name: str, *axes: Axis) -> DataFrame:
    """The labels that all axes have."""
    tables = [axis_table(spark, a, name) for a in axes]
    return reduce(lambda a, b: a.join(b, name, "left_semi"), tables)


def expand(keys: DataFrame, axis: Axis, name: str) -> DataFrame:
    """Each row of ``keys`` with each label of the axis, as column ``name``."""
    return _expand(keys, axis_table(keys.sparkSession, axis, name), name)


def _expand(keys: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """``labels`` has no label twice; a NULL among them is left out."""
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    needed = F.greatest(F.ceil(F.count(name) / CHUNK), F.lit(1)).cast("int")
    chunks = labels.agg(needed.alias("n")).scalar()
    buckets = F.ceil(F.lit(2 * parts) / chunks).cast("int")

    # never NULL, also to the planner, which would otherwise put a filter on it below the shuffles
    def place(number: Column, count: Column) -> Column:
        return F.coalesce(F.pmod(number, count).cast("int"), F.lit(0))

    chunk = place(F.xxhash64(name), chunks).alias("__chunk")
    packed = labels.select(name, chunk).groupBy("__chunk").agg(F.collect_list(name).alias("__labels"))
    packed = packed.withColumn("__bucket", F.explode(F.sequence(F.lit(0), buckets - 1)))
    columns = [F.col(f"`{c}`") for c in keys.columns]
    bucket = place(F.xxhash64(*columns), buckets) if columns else F.lit(0)
    asked = keys.withColumn("__bucket", bucket).withColumn("__chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
    # the number of partitions is given, so that few and small keys are not put together again
    met = asked.repartition(parts, "__bucket", "__chunk").join(packed, ["__bucket", "__chunk"])
    return met.select(*columns, F.explode("__labels").alias(name))


def domain_of(df: DataFrame, columns: list[str]) -> DataFrame:
    """The distinct combinations of some columns, in a form that several readers share.

    Keys and axis derived from it use one shuffle of ``df``. The filter holds for every
    row; it only keeps the planner from deriving each of them from ``df`` anew.
    """
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__cells"))
    return counted.filter("__cells > 0").drop("__cells")


def complete_grid(
    df: DataFrame,
    keys: list[str],
    axis: Axis | None = None,
    period: str = "period",
) -> DataFrame:
    """Every key with every period; cells that were absent get NULL measures.

    Without ``axis`` the periods are those of ``df``. Rows off the axis are dropped.
    """
    if axis is None:
        domain = domain_of(df, [*keys, period])
        grid = _expand(domain.select(*keys).distinct(), domain.select(period).distinct(), period)
    else:
        grid = expand(df.select(*keys).distinct(), axis, period)
    return null_safe_join(grid, df, [*keys, period], "left", not_null=[period]).select(*df.columns)


def complete_within(df: DataFrame, a: str, b: str) -> DataFrame:
    """Add a row for every combination of two columns that does not occur.

    The added rows are NULL in all other columns.
    """
    present = domain_of(df, [a, b])
    grid = _expand(present.select(a).distinct(), present.select(b).distinct(), b)
    absent = null_safe_join(grid, present, [a, b], "left_anti", not_null=[b])
    return df.unionByName(absent.select(a, b), allowMissingColumns=True)


def grid_of(spark: SparkSession, **axes: Axis) -> DataFrame:
    """The grid of some given axes, one column per axis."""
    (first, axis), *others = axes.items()
    out = axis_table(spark, axis, first)
    for name, axis in others:
        out = expand(out, axis, name)
    return out


def fill_entities(
    df: DataFrame,
    entities: Axis,
    fill: float | None = None,
    entity: str = "region",
    value: str = "value",
) -> DataFrame:
    """Exactly the given entities for every other key.

    Entities that were absent are added with ``fill``; entities not given are
    removed.
    """
    others = [c for c in df.columns if c not in (entity, value)]
    grid = expand(df.select(*others).distinct(), entities, entity)
    return _fill_cells(df, grid, entities, fill, entity, value, others)


def _fill_cells(df, grid, entities, fill, entity, value, others) -> DataFrame:
    # the grid has listed entities only, so the others find no cell in it
    cells = df.withColumn("__present", F.lit(True))
    out = null_safe_join(grid, cells, [*others, entity], "left", not_null=[entity])
    if fill is not None:
        out = out.withColumn(
            value, F.when(F.col("__present"), F.col(value)).otherwise(F.lit(float(fill)))
        )
    return out.select(*df.columns)


def copy_year(df: DataFrame, source: int, targets: list[int], period: str = "period") -> DataFrame:
    """Add a copy of one year's rows for each target year.

    One pass: the source year's rows are exploded, all others stay as they are.
    """
    years = F.when(
        F.col(period) == source, F.array(*[F.lit(y) for y in [source, *targets]])
    ).otherwise(F.array(F.col(period)))
    return df.withColumn(period, F.explode(years))


def copy_latest(df: DataFrame, targets: Sequence[int], period: str = "period") -> DataFrame:
    """Every target year that no row has gets a copy of the latest year's rows."""
    wanted = F.array(*[F.lit(int(y)) for y in targets])
    facts = df.agg(
        F.struct(
            F.max(period).alias("latest"),
            F.collect_set(F.when(member_of(F.col(period), targets), F.col(period))).alias("present"),
        ).alias("facts")
    ).scalar()
    copies = F.array_except(wanted, facts["present"])
    years = F.when(
        F.col(period) == facts["latest"], F.concat(F.array(F.col(period)), copies)
    ).otherwise(F.array(F.col(period)))
    return df.withColumn(period, F.explode(years))


def to_country_panel(
    df: DataFrame,
    countries: Axis,
    fill: float | None = None,
    null_to_zero: bool = False,
    region: str = "region",
    period: str = "period",
    value: str = "value",
) -> DataFrame:
    """Exactly the official countries, each with every category in every year.

    Cells that were absent get ``fill``; with ``null_to_zero`` present cells without
    a value become 0 first. The categories and the years come from one aggregate of ``df``,
    so ``df`` is read twice, for them and for its cells.
    """
    if null_to_zero:
        df = df.withColumn(value, F.coalesce(F.col(value), F.lit(0.0)))
    categories = [c for c in df.columns if c not in (region, period, value)]
    domain = domain_of(df, [*categories, period])
    grid = _expand(domain.select(*categories).distinct(), domain.select(period).distinct(), period)
    grid = expand(grid, countries, region)
    return _fill_cells(df, grid, countries, fill, region, value, [*categories, period])
