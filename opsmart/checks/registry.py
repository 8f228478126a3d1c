"""Query registration: a name, the Spark query, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from opsmart.checks.bindings import Tables, plain
from opsmart.checks.prelude import complete

Query = Callable[[Tables], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def check(
    name: str, sql: str | None = None, instead: Mapping[str, str] | None = None
) -> Callable[[Query], Query]:
    """Register a query over ``Tables`` and its SQL, with some definitions of it replaced."""

    def keep(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = complete(sql, instead)
        return query

    return keep


def runner(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    """The query as a function of a session and a data directory."""
    return lambda spark, sf_dir: plain(query(Tables(spark, sf_dir)))
