"""Named queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.found: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None) -> Callable[[Query], Query]:
        """Registers a function under its name; ``sql`` gives the same rows in DuckDB."""

        def add(function: Query) -> Query:
            self.found[function.__name__] = function
            if sql is not None:
                self.sql[function.__name__] = sql
            return function

        return add

    def queries(self) -> dict[str, Query]:
        return dict(self.found)

    def oracle_sql(self) -> dict[str, str]:
        return dict(self.sql)
