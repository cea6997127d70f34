"""Registry of the named queries and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function, under its own name if no other is given, with the SQL that must give the same rows."""

    def register(function: Query) -> Query:
        known_as = name or function.__name__
        if known_as in QUERIES:
            raise ValueError(f"query {known_as!r} is registered already")
        QUERIES[known_as] = function
        if oracle is not None:
            ORACLES[known_as] = oracle
        return function

    return register
