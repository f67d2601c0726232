"""Splits along an ordered key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators.ranking import dense_id
from touchline.operators.windows import Trailing, trailing
from touchline.session import written


def ordered_keys(df: DataFrame, key: str) -> DataFrame:
    """(key, key_rank) of the distinct keys in order."""
    return written(dense_id(df.select(key).distinct(), [key], "key_rank"), "keys")


def expanding_folds(df: DataFrame, key: str, folds: int = 4) -> DataFrame:
    """Rows with their ``block`` of consecutive keys: fold f trains on blocks below f and tests on block f.

    Blocks have keys / (folds + 1) keys, at least one; rows of later blocks take no part.
    """
    if folds <= 0:
        raise ValueError("folds must be positive")
    keys = ordered_keys(df, key)
    total = keys.agg(F.max("key_rank")).first()[0]
    if not total:
        raise ValueError("no keys to split")
    per_fold = max(1, total // (folds + 1))
    block = F.floor((F.col("key_rank") - 1) / per_fold).cast("int")
    return df.join(keys.select(key, block.alias("block")), key)


def fold(blocks: DataFrame, number: int) -> tuple[DataFrame, DataFrame]:
    return blocks.where(F.col("block") < number), blocks.where(F.col("block") == number)


def holdout_last(df: DataFrame, key: str, train_ratio: float = 0.9, compat: bool = False) -> tuple[DataFrame, DataFrame]:
    """Train and test rows, the test rows being those of the last keys.

    Their number is the distinct keys divided by the whole part of 1 / (1 - ratio).
    ``compat`` takes the keys of that many last rows instead, which are far fewer.
    """
    keys = ordered_keys(df, key)
    total = keys.agg(F.max("key_rank")).first()[0] or 0
    n = total // int(1 / (1 - train_ratio))
    if compat:
        # Without a count the whole list is taken: the last zero rows are all rows. Rows are counted per key
        # and added up, so no task sorts the last n of them.
        counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
        through = trailing(counted, [Trailing("_rows", "_through", None, True)], [], [key], any_size=True)
        last = through.where(F.col("_through") > df.count() - n).select(key) if n else keys.select(key)
    else:
        last = keys.where(F.col("key_rank") > total - n).select(key)
    return df.join(last, key, "left_anti"), df.join(last, key, "left_semi")
