"""Groups of any size.

A window over a group runs in a single task. Where the grain of a table bounds
its groups, such as the weeks of a player's season, that is the plan to have.
Where nothing bounds them, the caller says so and rows are numbered by a range
sort instead. The choice is the caller's and never depends on the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.session import written

# Rows of a few numbers each that may be broadcast once they are counted.
BROADCAST_ROWS = 100_000
# The same for one row per person or tenure, with a name or two dates.
BROADCAST_PEOPLE = 1_000_000

# monotonically_increasing_id() keeps the partition in the upper bits and the
# row number inside the partition in the lower 33 bits.
ROW_BITS = 33


def join_same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where NULL equals NULL; the keys appear once."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a side that is counted first and found small; otherwise no hint."""
    small = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if small else df


def numbered_by_range(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Number the rows of every group from 1 in ``order`` without a window over the group.

    One range exchange sorts all rows; each partition then knows its rows' places,
    and a table of (group, partition) starts, one row per group and partition,
    shifts them. The rows are written first with a random last sort column: copies
    of one row, however many, then spread over partitions, and sampling the bounds
    does not run the input twice. The sorted rows are written with their places, so
    the passes that follow read the same ones.
    """
    rows = written(df.withColumn("_tie", F.rand(0)), "to-number")
    sort = [*[F.col(k) for k in keys], *order, F.col("_tie")]
    place = F.monotonically_increasing_id()
    placed = written(
        rows.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .drop("_tie")
        .withColumn("_place", place)
        .withColumn("_part", F.shiftright("_place", ROW_BITS))
        .withColumn("_row", F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1)))
        .drop("_place"),
        "placed",
    )
    # One row per (group, partition): at most groups + partitions rows.
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(*keys, "_part")
        .agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .withColumn("_shift", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1)
        .drop("_first", "_rows")
    )
    # Without keys there is one row per partition.
    starts = bounded_broadcast(written(starts, "starts")) if keys else F.broadcast(starts)
    joined = join_same_keys(placed, starts, [*keys, "_part"])
    return joined.select(*df.columns, (F.col("_row") + F.col("_shift")).alias(name))


def row_numbers(
    df: DataFrame, keys: Sequence[str], orders: Mapping[str, Sequence[Column]], any_size: bool = False
) -> DataFrame:
    """``row_number`` over every group for each ``{name: order}``; ``any_size`` if nothing bounds a group."""
    if any_size:
        for name, order in orders.items():
            df = numbered_by_range(df, keys, order, name)
        return df
    return df.withColumns(
        {name: F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long") for name, order in orders.items()}
    )
