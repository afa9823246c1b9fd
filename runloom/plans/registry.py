"""Registry of the queries that run on the shared test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The parquet tables of one scale factor."""

    def __init__(self, spark: SparkSession, directory: str) -> None:
        self.spark = spark
        self.directory = directory.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.directory}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``function(tables) -> DataFrame`` with its SQL equivalent, if any."""

    def register(function: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, directory: str) -> DataFrame:
            return function(Tables(spark, directory))

        run.__name__ = name
        run.__doc__ = function.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register
