"""Collects queries by function name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def check(sql: str | None = None):
    """Register a query; `sql` may name the fixture views and FRI()."""

    def add(query):
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLE[query.__name__] = with_views(sql)
        return query

    return add


def with_views(sql: str) -> str:
    """Prepend the fixture views a statement uses as CTEs."""
    body = sql.strip()
    views = [f"{name} as ({text.strip()})" for name, text in fx.VIEWS.items() if name in body]
    if views:
        head = ",\n".join(views)
        body = f"with {head},\n{body[5:]}" if body[:5].lower() == "with " else f"with {head}\n{body}"
    return fx.duck_sql(body)
