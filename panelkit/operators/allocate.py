"""Moving amounts between groups: folding, splitting, blocs, limits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions import cells, member_of, sum_zero  # noqa: I001
from panelkit.operators.complete import Axis, axis_table, expand
from panelkit.operators.joins import lookup


def spread_groups(
    df: DataFrame,
    keys: list[str],
    groups: Sequence[str],
    group: str = "sector_group",
    value: str = "value",
    prefix: str = "",
) -> DataFrame:
    """One row per key with one column per group; an absent group is 0."""
    return df.groupBy(*keys).agg(
        *[sum_zero(F.when(F.col(group) == g, F.col(value))).alias(prefix + g) for g in groups]
    )


def gather_groups(
    df: DataFrame,
    keys: list[str],
    measures: Mapping[str, Mapping[str, Column]],
    group: str = "sector_group",
) -> DataFrame:
    """One row per key and group. ``measures`` maps output column to ``{group: Column}``."""
    groups = list(next(iter(measures.values())))
    rows = [
        F.struct(F.lit(g).alias(group), *[cols[g].alias(m) for m, cols in measures.items()])
        for g in groups
    ]
    return df.select(*keys, F.inline(F.array(*rows)))


def map_groups(
    df: DataFrame,
    keys: list[str],
    groups_of: Mapping[str, Sequence[str]],
    member: str,
    group: str = "sector_group",
    value: str = "value",
) -> DataFrame:
    """Roll members up to groups. Every group is present for every key, 0 if empty."""
    wanted = [m for members in groups_of.values() for m in members]
    sums = df.filter(F.col(member).isin(wanted)).groupBy(*keys).agg(
        *[
            sum_zero(F.when(F.col(member).isin(list(members)), F.col(value))).alias(f"__{g}")
            for g, members in groups_of.items()
        ]
    )
    return gather_groups(sums, keys, {value: {g: F.col(f"__{g}") for g in groups_of}}, group)


def fold_group(
    df: DataFrame,
    keys: list[str],
    source: str,
    targets: Sequence[str],
    keep: Sequence[str] = (),
    group: str = "sector_group",
    value: str = "value",
) -> DataFrame:
    """Add the ``source`` group to every target group.

    Groups in ``keep`` stay as they are, all others are dropped. Source rows are
    replicated before one map-side combined sum, so there is a single shuffle.
    """
    label = F.col(group)
    goes_to = F.when(label == source, F.array(*[F.lit(t) for t in targets])).when(
        member_of(label, [*targets, *keep]), F.array(label)
    )
    return (
        df.withColumn(group, F.explode(goes_to))
        .groupBy(*keys, group)
        .agg(sum_zero(F.col(value)).alias(value))
    )


def group_shares(
    df: DataFrame,
    keys: list[str],
    groups: Sequence[str],
    group: str = "sector_group",
    value: str = "value",
) -> DataFrame:
    """Each group's share of the sum of the groups, NULL where the sum is 0."""
    wide = spread_groups(df, keys, groups, group, value, "__")
    share = cells.shares({g: F.col(f"__{g}") for g in groups})
    return gather_groups(wide, keys, {value: share}, group)


def split_by_share(
    covered: DataFrame,
    base: DataFrame,
    keys: list[str],
    source: str,
    targets: Sequence[str],
    group: str = "sector_group",
    value: str = "value",
) -> DataFrame:
    """Distribute the ``source`` group over the targets in proportion to ``base``.

    Both inputs are brought to one row per key first, hash-partitioned alike, so
    the join adds no shuffle of its own.
    """
    have = spread_groups(covered, keys, [source, *targets], group, value, "__own_")
    want = spread_groups(base, keys, targets, group, value, "__base_")
    both = have.join(want, keys, "left")
    share = cells.shares({g: F.col(f"__base_{g}") for g in targets})
    own = {g: F.col(f"__own_{g}") for g in targets}
    return gather_groups(
        both, keys, {value: cells.split(own, F.col(f"__own_{source}"), share)}, group
    )


def reallocate_excess(
    covered: DataFrame,
    limit: DataFrame,
    keys: list[str],
    groups: Sequence[str],
    group: str = "sector_group",
    value: str = "value",
    capped: bool = False,
) -> DataFrame:
    """Move what a group has above its limit to the other of two groups.

    With ``capped`` the result is also limited to the other panel's values.
    """
    have = spread_groups(covered, keys, groups, group, value, "__own_")
    most = spread_groups(limit, keys, groups, group, value, "__max_")
    both = have.join(most, keys, "left")
    bound = {g: F.col(f"__max_{g}") for g in groups}
    moved = cells.reallocate({g: F.col(f"__own_{g}") for g in groups}, bound)
    out = cells.cap(moved, bound) if capped else moved
    return gather_groups(both, keys, {value: out}, group)


def zero_out(df: DataFrame, regions: Sequence[str], value: str = "value") -> DataFrame:
    """Set all cells of the listed regions to 0."""
    return df.withColumn(
        value, F.when(member_of(F.col("region"), regions), 0.0).otherwise(F.col(value))
    )


def expand_group(
    df: DataFrame,
    is_bloc: Column,
    members: Axis,
    keep: Column,
    changes: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Replace a bloc's rows by one copy per member; other rows stay if ``keep`` holds.

    ``changes`` sets further columns of the copies. Repeated bloc rows count once.
    """
    copies = expand(df.filter(is_bloc).drop("region").distinct(), members, "region").select(*df.columns)
    copies = copies.withColumns(dict(changes or {}))
    return df.filter(keep).unionByName(copies.select(*df.columns))


def net_of_group(
    df: DataFrame,
    own: Column,
    group: DataFrame,
    keys: list[str],
    value: str = "value",
) -> DataFrame:
    """Replace the ``own`` rows by what they exceed the ``group`` value of their key.

    Rows that do not exceed it are removed, and so are rows whose key has no
    group value. ``df`` is read once; ``own`` is part of the join condition, so all
    other rows pass through. A row for which ``own`` is NULL is dropped.
    """
    amounts = group.select(
        *[F.col(k).alias(f"__g_{k}") for k in keys], F.col(value).alias("__group")
    )
    matches = own
    for k in keys:
        matches = matches & (F.col(k) == F.col(f"__g_{k}"))
    net = F.col(value) - F.col("__group")
    return (
        df.join(amounts, matches, "left")
        .filter(~own | (own & (net > 0)))
        .withColumn(value, F.when(own, net).otherwise(F.col(value)))
        .select(*df.columns)
    )


def allocate_group_total(
    totals: DataFrame,
    base: DataFrame,
    members: Axis,
    period: str = "period",
    value: str = "value",
) -> DataFrame:
    """Distribute a bloc total per period over its members in proportion to ``base``.

    ``totals`` is ``(period, value)``, ``base`` is ``(region, period, value)``. A member
    gets 0 in periods without a bloc total.

    The members are joined, not filtered by: a filter would reach below the aggregate that
    made ``base``, which then could not share its shuffle with other readers.
    """
    inside = base.join(axis_table(base.sparkSession, members, "region"), "region")
    sums = inside.groupBy(period).agg(sum_zero(F.col(value)).alias("__base"))
    share = totals.join(sums, period, "left").select(
        period, F.try_divide(F.col(value), F.col("__base")).alias("__share")
    )
    return (
        lookup(inside, share, {period: period})
        .withColumn(value, F.coalesce(F.col(value) * F.col("__share"), F.lit(0.0)))
        .select(*base.columns)
    )
