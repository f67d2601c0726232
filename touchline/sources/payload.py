"""Nested JSON payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_payload(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One row per payload file, its arrays kept nested."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def flatten(payload: DataFrame, array: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per entry of an array of structs."""
    return payload.select(*keep, F.inline(F.col(array)))


def current_period(events: Column) -> Column:
    """Id of the first event marked current, 0 when none is."""
    current = F.filter(events, lambda e: e["is_current"])
    return F.coalesce(F.get(current, F.lit(0))["id"], F.lit(0))


def json_field(text: Column, path: str, kind: str = "string") -> Column:
    """A field of a JSON text; NULL where it is absent or of another type."""
    return F.get_json_object(text, path).try_cast(kind)
