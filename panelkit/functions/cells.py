"""Arithmetic between the sector groups of one (region, period) row.

Each function takes and returns ``{group: Column}``. With the groups side by
side in one row, folding, splitting, reallocating and capping are plain column
expressions: no join and no shuffle between the steps.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelkit.functions.missing import least_strict, ratio_or_zero

Cells = dict[str, Column]


def zero_if_null(cells: Cells) -> Cells:
    return {g: F.coalesce(c, F.lit(0.0)) for g, c in cells.items()}


def fold(cells: Cells, source: Column) -> Cells:
    """Add an economy-wide amount to every group."""
    return {g: c + source for g, c in cells.items()}


def shares(cells: Cells) -> Cells:
    """Each group's part of the sum of the groups, NULL if the sum is 0."""
    total = reduce(add, cells.values())
    return {g: F.try_divide(c, total) for g, c in cells.items()}


def split(own: Cells, total: Column, share: Cells) -> Cells:
    """Add to each group its share of an economy-wide amount."""
    return {g: c + total * share[g] for g, c in own.items()}


def reallocate(cells: Cells, limit: Cells) -> Cells:
    """Move what exceeds the limit to the other group, for two groups at once."""
    a, b = cells
    excess = {
        g: F.coalesce(F.when(cells[g] > limit[g], cells[g] - limit[g]), F.lit(0.0)) for g in cells
    }
    kept = zero_if_null(cells)
    return {a: kept[a] - excess[a] + excess[b], b: kept[b] - excess[b] + excess[a]}


def cap(cells: Cells, limit: Cells) -> Cells:
    return {g: least_strict(c, limit[g]) for g, c in cells.items()}


def coverage(cells: Cells, base: Cells) -> Cells:
    return {g: ratio_or_zero(c, base[g]) for g, c in cells.items()}
