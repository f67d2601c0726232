"""Joins of many rows with one row per key, when one key may hold a third of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys with more than this share of all rows are broadcast; there are fewer of them than its inverse.
HOT_SHARE = 1 / 1000
HOT_ROWS = 1000


def join_counted(rows: DataFrame, keyed: DataFrame, keys: Sequence[str], count: str, how: str = "inner") -> DataFrame:
    """Inner or semi join of ``rows`` with ``keyed``, whose ``count`` says how many rows have its key.

    A key with many rows is broadcast, so its rows stay where they are; at most a
    thousand keys can be that frequent. All others meet by a shuffle.
    """
    total = keyed.agg(F.sum(count)).first()[0] or 0
    frequent = F.col(count) > F.lit(max(HOT_ROWS, int(total * HOT_SHARE)))
    hot = keyed.where(frequent).drop(count)
    cold = keyed.where(~frequent).drop(count)
    if hot.isEmpty():
        return rows.join(cold, [*keys], how)
    rest = rows.join(F.broadcast(hot.select(*keys)), [*keys], "left_anti")
    return rows.join(F.broadcast(hot), [*keys], how).unionByName(rest.join(cold, [*keys], how))
