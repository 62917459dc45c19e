"""Names of the engine's queries and of the DuckDB SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Catalog:
    """A small registry: modules of queries add themselves with :meth:`add`."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def put(f: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"two queries are named {name}")
            self.queries[name] = f
            if sql is not None:
                self.sql[name] = sql
            return f

        return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables in a directory of Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
