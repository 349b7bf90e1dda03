"""Collects the registered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from agora.session import pin

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` gives the same rows on the same tables, with the same column names."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(pin(spark), sf_dir.rstrip("/"))

        run.__name__, run.__doc__ = name, function.__doc__
        QUERIES[name] = run
        if sql:
            SQL[name] = sql.strip()
        return function

    return register
