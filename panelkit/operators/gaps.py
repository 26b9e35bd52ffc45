"""Filling gaps in time series.

The x-axis of the interpolation is the position of a row in its series unless
``by="period"`` is asked for. A gap before the first known value takes that
value, a gap after the last known one takes the last. A series without any
value stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampType

from panelkit.operators.complete import Axis, axis_of, axis_table, on_axis
from panelkit.operators.joins import null_safe_join
from panelkit.operators.ranks import ranked

PARTS = ("linear", "forward", "backward")
RANGES = 32  # parts in which an axis is numbered


def _between(prev: Column, nxt: Column, x: Column) -> Column:
    """Value at ``x`` on the line between two known (value, x) points."""
    return prev["v"] + (nxt["v"] - prev["v"]) * (x - prev["x"]) / (nxt["x"] - prev["x"])


def _filled(value: Column, prev: Column, nxt: Column, x: Column, parts) -> Column:
    steps = {"linear": _between(prev, nxt, x), "forward": prev["v"], "backward": nxt["v"]}
    return F.coalesce(value, *[steps[p] for p in PARTS if p in parts])


def fill_gaps(
    df: DataFrame,
    keys: list[str],
    period: str = "period",
    value: str = "value",
    by: str = "position",
    parts=PARTS,
) -> DataFrame:
    """Fill NULL values between, after and before the known values of each series.

    One exchange on the series key. The search for the next known value runs
    over the reversed order, so both searches take one step per row. A series
    has one row per period; for long period axes see :func:`fill_gaps_chunked`.
    """
    forward = Window.partitionBy(*keys).orderBy(F.col(period))
    backward = Window.partitionBy(*keys).orderBy(F.col(period).desc())
    x = F.row_number().over(forward) if by == "position" else F.col(period)
    point = F.when(
        F.col(value).isNotNull(), F.struct(F.col(value).alias("v"), F.col("__x").alias("x"))
    )
    return (
        df.withColumn("__x", x)
        .withColumn("__point", point)
        .withColumn("__prev", F.last("__point", ignorenulls=True).over(forward))
        .withColumn("__next", F.last("__point", ignorenulls=True).over(backward))
        .withColumn(
            value, _filled(F.col(value), F.col("__prev"), F.col("__next"), F.col("__x"), parts)
        )
        .drop("__x", "__point", "__prev", "__next")
    )


def fill_gaps_chunked(
    df: DataFrame,
    keys: list[str],
    chunk: int,
    period: str = "period",
    value: str = "value",
    by: str = "position",
    parts=PARTS,
) -> DataFrame:
    """As :func:`fill_gaps`, for long series or when one series dominates the table.

    Series are cut into chunks of ``chunk`` periods that are filled in parallel.
    Only one summary row per chunk (its number of rows, first and last known
    point) is ordered over the whole series, to carry points across chunks.
    """
    part = [*keys, "__chunk"]
    forward = Window.partitionBy(*part).orderBy(F.col(period))
    backward = Window.partitionBy(*part).orderBy(F.col(period).desc())
    x = F.row_number().over(forward) if by == "position" else F.col(period).cast("long")
    local = (
        df.withColumn("__chunk", F.floor(F.col(period) / F.lit(chunk)))
        .withColumn("__x", x.cast("long"))
        .withColumn(
            "__point",
            F.when(
                F.col(value).isNotNull(), F.struct(F.col(value).alias("v"), F.col("__x").alias("x"))
            ),
        )
    )

    first_known = F.min_by("__point", F.when(F.col("__point").isNotNull(), F.col("__x")))
    last_known = F.max_by("__point", F.when(F.col("__point").isNotNull(), F.col("__x")))
    summary = local.groupBy(*part).agg(
        F.count(F.lit(1)).alias("__n"),
        first_known.alias("__first"),
        last_known.alias("__last"),
    )
    chunks = Window.partitionBy(*keys).orderBy("__chunk")
    before = chunks.rowsBetween(Window.unboundedPreceding, -1)
    after = (
        Window.partitionBy(*keys)
        .orderBy(F.col("__chunk").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offset = F.coalesce(F.sum("__n").over(before), F.lit(0)) if by == "position" else F.lit(0)

    def shifted(point: str) -> Column:
        p = F.col(point)
        return F.when(p.isNotNull(), F.struct(p["v"].alias("v"), (p["x"] + F.col("__off")).alias("x")))

    carried = (
        summary.withColumn("__off", offset.cast("long"))
        .withColumn("__first", shifted("__first"))
        .withColumn("__last", shifted("__last"))
        .select(
            *part,
            "__off",
            F.last("__last", ignorenulls=True).over(before).alias("__carry_prev"),
            F.last("__first", ignorenulls=True).over(after).alias("__carry_next"),
        )
    )

    prev = F.last("__point", ignorenulls=True).over(forward)
    nxt = F.last("__point", ignorenulls=True).over(backward)
    local = local.withColumn("__p", prev).withColumn("__q", nxt)
    joined = null_safe_join(local, carried, part, "left")
    return (
        joined.withColumn("__p", F.coalesce(shifted("__p"), F.col("__carry_prev")))
        .withColumn("__q", F.coalesce(shifted("__q"), F.col("__carry_next")))
        .withColumn("__x", F.col("__x") + F.col("__off"))
        .withColumn(value, _filled(F.col(value), F.col("__p"), F.col("__q"), F.col("__x"), parts))
        .select(*df.columns)
    )


def complete_and_fill(
    df: DataFrame,
    keys: list[str],
    axis: Axis,
    period: str = "period",
    value: str = "value",
    by: str = "position",
    series: DataFrame | None = None,
) -> DataFrame:
    """Every key on every period of the axis, gaps filled, in one exchange.

    Same result as completing the grid and then filling it, but the grid is
    never joined: each known point emits the periods up to the next known one.
    Keys listed in ``series`` are present even if ``df`` has no row for them; they
    cost one row each, not one per period. Rows are ``keys, period, value``.

    Periods are numbered in a table of their own, which is joined. Two values of one key
    and period are an error.
    """
    labels = axis_table(df.sparkSession, axis, "__axis")
    points = numbered(labels, "__axis", "__slot")
    last = labels.agg(F.count("__axis").cast("int").alias("n")).scalar()
    w = Window.partitionBy(*keys).orderBy(F.col("__known").desc(), F.col("__slot"))
    cells = df.join(points, F.col(period) == F.col("__axis")).select(*keys, period, "__slot", value)
    if series is not None:
        stand_ins = series.select(
            *keys,
            F.lit(None).cast(df.schema[period].dataType).alias(period),
            F.lit(1).alias("__slot"),
            F.lit(None).cast("double").alias(value),
        )
        cells = cells.unionByName(stand_ins)
    sparse = (
        cells.withColumn("__known", F.col(value).isNotNull())
        .withColumn("__rank", F.row_number().over(w))
        .withColumn("__next_v", F.lead(value).over(w))
        .withColumn("__next_p", F.lead(F.when(F.col("__known"), F.col(period))).over(w))
        .withColumn("__next_slot", F.lead(F.when(F.col("__known"), F.col("__slot"))).over(w))
        # known points, or one row to stand for a series without any
        .filter(F.col("__known") | (F.col("__rank") == 1))
    )
    twice = F.raise_error(F.lit(f"two values of one key {keys} and {period}")).cast("int")
    low = F.when(F.col("__rank") == 1, F.lit(1)).otherwise(F.col("__slot"))
    low = F.when(F.col("__slot") == F.col("__next_slot"), twice).otherwise(low)
    high = F.when(F.col("__next_p").isNull(), last).otherwise(F.col("__next_slot") - 1)
    named = points.select(F.col("__slot").alias("__at"), F.col("__axis").alias("__at_p"))
    out = sparse.withColumn("__at", F.explode(F.sequence(low, high))).join(named, "__at")
    if by == "position":
        here, start, stop = F.col("__at"), F.col("__slot"), F.col("__next_slot")
    else:
        here, start, stop = F.col("__at_p"), F.col(period), F.col("__next_p")
    v, n = F.col(value), F.col("__next_v")
    line = v + (n - v) * (here - start) / (stop - start)
    inside = F.col("__next_p").isNotNull() & (F.col("__at") > F.col("__slot"))
    return out.select(
        *keys,
        F.col("__at_p").alias(period),
        F.when(inside, line).otherwise(v).alias(value),
    )


def numbered(labels: DataFrame, column: str, name: str) -> DataFrame:
    """``labels``, a table of distinct labels, with the number of each in their order, from 1.

    No task sees them all: approximate percentiles cut numbers and dates into ``RANGES`` ranges,
    labels are numbered in their range, and the sizes of the ranges before it are added. Other
    labels are numbered by :func:`ranked`.
    """
    kind = labels.schema[column].dataType
    if not isinstance(kind, NumericType | DateType | TimestampType):
        return ranked(labels, [column], name=name).withColumn(name, F.col(name).cast("int"))
    cuts = [i / RANGES for i in range(1, RANGES)]
    bounds = labels.agg(F.percentile_approx(column, cuts, 10 * RANGES).alias("bounds")).scalar()
    after = [F.coalesce(F.col("__bounds")[i] < F.col(column), F.lit(False)).cast("int") for i in range(RANGES - 1)]
    ranged = labels.withColumn("__bounds", bounds).withColumn("__range", sum(after[1:], after[0])).drop("__bounds")
    sizes = [F.count_if(F.col("__range") < i).cast("int") for i in range(RANGES)]
    offsets = ranged.agg(F.array(*sizes).alias("offsets")).scalar()
    own = F.row_number().over(Window.partitionBy("__range").orderBy(column))
    placed = ranged.withColumn("__own", own).withColumn("__offsets", offsets)
    return placed.withColumn(name, F.col("__own") + F.col("__offsets")[F.col("__range")]).select(*labels.columns, name)


def fill_years(df: DataFrame, years: Axis, keys: list[str] | None = None) -> DataFrame:
    """Bring every series to the listed years: linear between, constant outside."""
    if keys is None:
        keys = [c for c in df.columns if c not in ("period", "value")]
    listed = axis_table(df.sparkSession, years, "period")
    # points off the list still shape the line between listed years
    every = listed.union(axis_of(df, "period"))
    filled = complete_and_fill(df, keys, every, by="period")
    return on_axis(filled, "period", years).select(*df.columns)


def zero_fill(df: DataFrame, flag: Column, value: str = "value") -> DataFrame:
    """NULL values become 0 where the flag holds."""
    return df.withColumn(
        value, F.when(flag, F.coalesce(F.col(value), F.lit(0.0))).otherwise(F.col(value))
    )
