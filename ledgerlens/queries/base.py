"""Registry of queries, each beside the SQL that it has to equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ship

Query = Callable[["Tables"], DataFrame]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """Tables of a folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


def query(sql: str | None = None):
    """Registers a function of ``Tables`` under its name."""
    def add(f: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return f(Tables(spark, folder))
        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = sql
        return f
    return add
