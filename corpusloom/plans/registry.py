"""A named collection of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None) -> Callable[[Query], Query]:
        """Register a query under its function's name; without SQL it has no oracle."""

        def register(query: Query) -> Query:
            self.queries[query.__name__] = query
            if sql is not None:
                self.sql[query.__name__] = sql
            return query

        return register
