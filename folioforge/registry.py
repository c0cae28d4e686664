"""All queries of the library, by name, with the SQL that each is held against."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}
FLAGSHIP: Callable | None = None


def queries() -> dict[str, Callable]:
    import folioforge.plans.harvest_queries
    import folioforge.plans.io_queries
    import folioforge.plans.journal_queries
    import folioforge.plans.queries  # noqa: F401  (fills the tables)

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
