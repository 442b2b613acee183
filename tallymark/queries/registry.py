"""Named queries over the test tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallymark.fixtures import with_fixtures

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, on_fixtures: bool = True) -> Callable[[Query], Query]:
    """Register a query, and its SQL over the fixture views (or over the tables alone)."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is already there")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = with_fixtures(sql) if on_fixtures else sql
        return function

    return register
