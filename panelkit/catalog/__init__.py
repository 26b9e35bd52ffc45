"""The queries on the shared test tables, each with its check in SQL."""

from panelkit.catalog import (  # noqa: F401
    allocation,
    completion,
    dashboard,
    extensions,
    files,
    imputation,
    labels,
    totals,
)
from panelkit.catalog.registry import oracle_sql, queries  # noqa: F401
