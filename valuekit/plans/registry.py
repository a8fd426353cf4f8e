"""Named queries over the driver's tables, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit.session import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """``t("orders")`` reads a table, ``t.path("orders")`` is its place."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}.parquet"

    def __call__(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))


def query(name: str, sql: str | None = None):
    """Register a query ``fn(t)`` over ``Tables``; ``sql`` is its check, if SQL can say it."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(ship(spark), folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def r4(value: Column) -> Column:
    """Four decimals. The small shift sends exact halves the same way on both sides of the check."""
    return F.round(value + 1e-9, 4)


def sql_r4(value: str) -> str:
    return f"round(({value}) + 1e-9, 4) + 0.0"


def long(value: Column) -> Column:
    return value.cast("long")
