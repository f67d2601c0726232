"""Prediction tables that only grow, load by load, and may be loaded again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators.ranking import dense_id

PREDICTION_COLUMNS = ["player_id", "fixture_id", "predicted_goals", "predicted_assists"]
# Ids a load may use: load n has those above n times this number.
IDS_PER_LOAD = 1 << 32


def number_predictions(new: DataFrame, load: int = 0) -> DataFrame:
    """New rows with ids from the range of their load, its number, and the time of loading.

    All four columns are required: a NULL fails the load, as do more rows than a range has ids.
    """
    missing = F.raise_error(F.lit("NULL in a required prediction column"))
    required = new.select(
        *[F.coalesce(F.col(c), missing.cast(new.schema[c].dataType)).alias(c) for c in PREDICTION_COLUMNS]
    )
    rows = dense_id(required, ["fixture_id", "player_id"], "prediction_id")
    full = F.raise_error(F.lit("more rows than a load has ids")).cast("long")
    number = F.when(F.col("prediction_id") < IDS_PER_LOAD, F.col("prediction_id") + load * IDS_PER_LOAD).otherwise(full)
    return rows.withColumns(
        {"prediction_id": number, "prediction_timestamp": F.current_timestamp(), "load": F.lit(load).cast("int")}
    )


def append_predictions(new: DataFrame, path: str, load: int = 0) -> DataFrame:
    """Add a load to the Parquet table at ``path`` and return the whole table.

    A load is a partition of the table and replaces itself, rows and ids, so a
    retried or repeated one changes nothing. Its ids depend on no other load, so
    loads may run at the same time. A repeated load without rows leaves the
    earlier one as it is.
    """
    if load < 0:
        raise ValueError("loads are numbered from 0")
    rows = number_predictions(new, load)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("load").parquet(path)
    # The schema is given, so a table without any rows can be read too.
    return new.sparkSession.read.schema(rows.schema).parquet(path)
