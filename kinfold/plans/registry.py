"""Registry of the engine's queries and of the SQL that each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of a folder, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self._spark.read.parquet(f"{self._folder}/{name}.parquet")


def query(sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Registers a function of the tables under its own name, with the SQL for its rows if there is any."""

    def add(plan: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[plan.__name__] = lambda spark, folder: plan(Tables(spark, folder))
        if sql:
            ORACLES[plan.__name__] = sql
        return plan

    return add

