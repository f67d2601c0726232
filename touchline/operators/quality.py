"""Data checks as one result table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.columns import open_end


def check(
    df: DataFrame,
    unique: Sequence[str | Sequence[str]] = (),
    not_null: Sequence[str] = (),
    required: Sequence[str] = (),
    not_empty: bool = False,
) -> DataFrame:
    """(check, column, failures): failing keys for unique, rows for not_null, 1 for a missing column or no rows.

    NULL keys do not count as duplicates. All row counts come from one pass;
    every unique key adds one aggregation.
    """
    spark = df.sparkSession
    missing = [c for c in required if c not in df.columns]
    results = [
        spark.createDataFrame(
            [("required", c, int(c in missing)) for c in required], "check string, column string, failures long"
        )
    ]
    counts = {f"not_null\t{c}": F.count_if(F.col(c).isNull()) for c in not_null}
    if not_empty:
        counts["not_empty\t*"] = F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("long")
    if counts:
        one = df.agg(*[value.alias(label) for label, value in counts.items()])
        results.append(
            one.unpivot([], list(counts), "label", "failures").select(
                F.split_part("label", F.lit("\t"), F.lit(1)).alias("check"),
                F.split_part("label", F.lit("\t"), F.lit(2)).alias("column"),
                "failures",
            )
        )
    for key in unique:
        keys = [key] if isinstance(key, str) else list(key)
        duplicated = df.dropna(subset=keys).groupBy(*keys).count().where("count > 1")
        results.append(
            duplicated.agg(F.count(F.lit(1)).alias("failures")).select(
                F.lit("unique").alias("check"), F.lit(",".join(keys)).alias("column"), "failures"
            )
        )
    return reduce(DataFrame.unionByName, results)


def overlapping(df: DataFrame, key: str, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Intervals that begin before an earlier one of the same key has ended.

    A key has few intervals (one per team), so a window over it stays small.
    """
    earlier = Window.partitionBy(key).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    latest_end = F.max(open_end(F.col(end))).over(earlier)
    return df.withColumn("_latest_end", latest_end).where(F.col("_latest_end") > F.col(start)).drop("_latest_end")
