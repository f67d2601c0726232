"""Surrogate keys, ranks and top rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.skew import numbered_by_range, row_numbers


def dense_id(df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """Ids 1..n in the order of ``order_by``, NULL last; remaining columns break ties.

    A window without partitions would sort the table in one task; the range sort
    numbers every partition on its own.
    """
    rest = [c for c in df.columns if c not in order_by]
    order = [F.col(c).asc_nulls_last() for c in [*order_by, *rest]]
    numbered = numbered_by_range(df, [], order, name)
    return numbered.select(name, *df.columns)


def ranked(
    df: DataFrame, keys: Sequence[str], orders: Mapping[str, Sequence[Column]], any_size: bool = False
) -> DataFrame:
    """Ranks 1..n inside each group, one per ``{name: order}``; orders have to be total.

    ``any_size`` says that no grain bounds a group.
    """
    return row_numbers(df, keys, orders, any_size)


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, name: str = "_rank") -> DataFrame:
    """The first ``n`` rows of each group, with their rank.

    Up to ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000) the literal bound lets Spark cut every
    map task's groups to ``n`` rows before the exchange; beyond it whole groups are exchanged.
    """
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(name, number).where(F.col(name) <= n)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``."""
    return first_rows(df, keys, order, 1).drop("_rank")


def capped_top_k(
    df: DataFrame,
    period: Sequence[str],
    group: str,
    caps: Mapping[str, int],
    k: int,
    order: Sequence[Column],
    name: str = "selection_rank",
) -> DataFrame:
    """The best ``k`` rows per period with at most ``caps[group]`` from each group.

    Taking rows in order and skipping full groups picks exactly the rows that are
    within their group's cap, then the first ``k`` of those. Groups without a cap
    are not selected.
    """
    cap = F.element_at(F.create_map(*[F.lit(x) for pair in caps.items() for x in pair]), F.col(group))
    known = df.where(F.col(group).isin(list(caps)))
    within = first_rows(known, [*period, group], order, max(caps.values()), "_group_rank")
    within = within.where(F.col("_group_rank") <= cap).drop("_group_rank")
    return first_rows(within, period, order, k, name)


def first_n(df: DataFrame, condition: Column, order: Sequence[Column], n: int) -> DataFrame:
    """Filter, sort and keep the first ``n`` rows of the whole table."""
    return df.where(condition).orderBy(*order).limit(n)
