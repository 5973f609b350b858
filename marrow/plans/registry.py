"""All queries of the core and their SQL."""

from __future__ import annotations

from marrow.plans import core_queries, core_sql


def queries() -> dict[str, core_queries.Query]:
    return dict(core_queries.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(core_sql.SQL)
