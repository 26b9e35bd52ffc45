"""Column expressions for labels, units and text cells."""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelkit.constants import RELATIVE_UNIT_PATTERN


def recode(col: Column, labels: Mapping[str, str], default: Column | None = None) -> Column:
    """Replace listed labels; an unlisted one becomes ``default`` (NULL if not given)."""
    out = F.lit(None).cast("string") if default is None else default
    for old, new in reversed(labels.items()):
        out = F.when(col == old, F.lit(new)).otherwise(out)
    return out


def recoded_to(col: Column, labels: Mapping[str, str], wanted: Iterable[str]) -> Column:
    """Whether ``recode(col, labels)`` is one of the wanted labels, asked of the column itself.

    The same rows as a filter on the recoded column, but the condition names raw values, so
    it reaches the scan.
    """
    chosen = set(wanted)
    return col.isin([old for old, new in labels.items() if new in chosen])


def in_years(date: Column, years: Iterable[int]) -> Column:
    """Whether a date or timestamp lies in one of the years, as ranges that reach the scan."""
    out, listed = F.lit(False), sorted(set(years))
    for i, first in enumerate(listed):
        if i and listed[i - 1] == first - 1:
            continue
        last = first
        while last + 1 in listed:
            last += 1
        out = out | ((date >= F.lit(datetime.date(first, 1, 1))) & (date < F.lit(datetime.date(last + 1, 1, 1))))
    return out


def extract_groups(col: Column, pattern: str, count: int) -> list[Column]:
    """The capture groups of ``pattern`` as columns, NULL where the text does not match."""
    return [
        F.when(col.rlike(pattern), F.regexp_extract(col, pattern, i))
        for i in range(1, count + 1)
    ]


def is_relative_unit(unit: Column) -> Column:
    """True for units that are shares, rates or indices, NULL for no unit."""
    return F.lower(unit).rlike(RELATIVE_UNIT_PATTERN)


def weight_choice(weight: Column) -> Column:
    """Name of the weight to use: ``gdp`` where asked for, else ``pop``."""
    return F.when(F.lower(weight) == "gdp", F.lit("gdp")).otherwise(F.lit("pop"))


def pick(choice: Column, columns: Mapping[str, Column]) -> Column:
    """Value of the column that ``choice`` names in each row."""
    return F.coalesce(*[F.when(choice == name, col) for name, col in columns.items()])


def file_stem(name: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(name, r"\.[^.]*$", "")
