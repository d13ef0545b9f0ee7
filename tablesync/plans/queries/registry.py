from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
#: Makers of sample rows, which only tests run: their rows come from ids, not from the given tables.
MAKERS: dict[str, Query] = {}
MAKER_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with the SQL to compare it with."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def maker(sql: str) -> Callable[[Query], Query]:
    """Note a maker of sample rows with the SQL to compare it with, without registering it."""

    def note(function: Query) -> Query:
        MAKERS[function.__name__] = function
        MAKER_SQL[function.__name__] = sql
        return function

    return note
