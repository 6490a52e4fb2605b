"""Queries on the driver's tables, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.session import configure
from millrace.sources.load import table


class Tables:
    """The driver's tables as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query on ``Tables`` under ``name`` together with its oracle SQL."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(configure(spark), folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load_all() -> None:
    from millrace.catalog import (  # noqa: F401
        aggregates,
        documents,
        joins,
        jobs,
        loads,
        merges,
        projections,
        scalars,
        trees,
    )
