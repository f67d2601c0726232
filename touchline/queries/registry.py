"""Queries over the test tables and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query with the SQL it has to agree with.

    Its name is the function's without a trailing ``_query``, which functions
    named like the operator they run carry.
    """

    def register(function: Query) -> Query:
        name = function.__name__.removesuffix("_query")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def exact(value: str | Column) -> Column:
    """Amounts as decimals, so that sums do not depend on order."""
    return (F.col(value) if isinstance(value, str) else value).cast("decimal(18,4)")


def plain(value: str | Column) -> Column:
    """A decimal sum as a double for output."""
    return (F.col(value) if isinstance(value, str) else value).cast("double")


def month_index(date: str) -> Column:
    return (F.year(date) * 12 + F.month(date)).cast("int")
