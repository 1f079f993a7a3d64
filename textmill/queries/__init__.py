"""Registered queries: each runs an operator over the given tables.

A query may carry the SQL that another engine runs on the same tables to check
its result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function of (session, table folder) under a name."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def load_all() -> None:
    """Import every module that registers queries."""
    from textmill.queries import (  # noqa: F401
        cleaning,
        feeding_back,
        files,
        learning,
        reports,
        sizing,
    )
