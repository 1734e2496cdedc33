"""Registry of the queries and of the SQL that must return the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from forumlens.workload.views import VIEWS, Tables, view_sql

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, like: str | None = None):
    """Register ``fn(tables)`` under ``name``, with its equivalent SQL if there is one, or that of another query."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql)
        elif like is not None:
            ORACLES[name] = ORACLES[like]
        return fn

    return register


def mentioned_views(sql: str) -> list[str]:
    """Views used by ``sql``, dependencies first."""
    found: list[str] = []
    for name in VIEWS:
        if re.search(rf"\b{name}\b", sql):
            for needed in [*mentioned_views(VIEWS[name]), name]:
                if needed not in found:
                    found.append(needed)
    return found


def with_views(sql: str) -> str:
    """Put the definitions of the stand-in views in front of a query body."""
    body = sql.strip()
    ctes = [f"{name} AS ({view_sql(name)})" for name in mentioned_views(body)]
    head = re.match(r"WITH\s+(RECURSIVE\s+)?", body)
    recursive = "RECURSIVE " if head and head.group(1) else ""
    if head:
        return f"WITH {recursive}" + ",\n".join([*ctes, body[head.end():]])
    return f"WITH {', '.join(ctes)}\n{body}" if ctes else body


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    fn = QUERIES[name]
    return lambda spark, sf_dir: fn(Tables(spark, sf_dir))
