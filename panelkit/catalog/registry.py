"""Registration of queries and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function, under its own or the given name, together with its SQL.

    A name is given where the function's own would hide the operator it shows.
    """

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        _QUERIES[key] = fn
        _SQL[key] = sql
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def rounded(df: DataFrame, *columns: str, places: int = 8) -> DataFrame:
    """Round the last bits off, in which sums differ between engines."""
    return df.withColumns({c: F.round(c, places) for c in columns or ("value",)})
