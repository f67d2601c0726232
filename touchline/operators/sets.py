"""Set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators.skew import join_same_keys
from touchline.session import written


def outer_union(*tables: DataFrame) -> DataFrame:
    """All rows of all tables; absent columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def union_distinct(*tables: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), tables).distinct()


def columns_of_distinct(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``df.distinct().select(*columns)`` for rows that seldom share ``keys``, which are among the columns.

    Only rows that share their keys are compared whole, so the other columns are not shuffled
    for the rest. ``df`` is read again for those, and has to give the same rows.
    """
    taken = written(df.select(*columns), "taken")
    counted = taken.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    shared = written(counted.where(F.col("_rows") > 1).select(*keys), "shared-keys")
    compared = written(join_same_keys(df, shared, keys, "left_semi").distinct().select(*columns), "compared")
    return join_same_keys(taken, shared, keys, "left_anti").unionByName(compared)


def common_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def missing_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that ``b`` lacks."""
    return a.subtract(b)


def missing_columns(a: DataFrame, b: DataFrame) -> list[str]:
    """Columns of ``a`` that ``b`` lacks."""
    return [c for c in a.columns if c not in b.columns]
