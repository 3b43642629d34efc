"""Queries by name, each with its SQL where SQL can express it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catalogue.inputs import VIEWS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _mentions(sql: str) -> list[str]:
    words = set(re.findall(r"[a-z_0-9]+", sql))
    return [v for v in VIEWS if v in words]


def with_views(sql: str) -> str:
    """``sql`` with the views it needs, directly or not, as leading CTEs."""
    ordered: list[str] = []

    def visit(view: str) -> None:
        if view not in ordered:
            for other in _mentions(VIEWS[view]):
                if other != view:
                    visit(other)
            ordered.append(view)

    for view in _mentions(sql):
        visit(view)
    ctes = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in ordered)
    return f"WITH {ctes}\n{sql}" if ctes else sql


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name."""

    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add
