"""Groups of any size have to give what plain windows give."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from touchline.operators.ranking import dense_id, ranked
from touchline.operators.skew import numbered_by_range
from touchline.operators.windows import Trailing, trailing

@pytest.fixture(scope="module")
def skewed(spark):
    """One group with a third of all rows, one NULL key, NULL values."""
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{rng.randrange(60)}"
        rows.append((key, rng.randrange(500), i, None if rng.random() < 0.1 else rng.randrange(100)))
    frame = spark.createDataFrame(rows, "key string, at int, id int, value int").repartition(5)
    amount = (F.col("value") / 7).cast("decimal(18,4)")
    # Halves add up without rounding in any order.
    return frame.withColumns({"amount": amount, "half": F.col("value") / 2}).cache()


AGGREGATES = ["sum", "avg", "count", "min", "max"]
FRAMES = {"ub": (None, False), "ub_now": (None, True), "last3": (3, False), "last6_now": (6, True)}
SPECS = [
    Trailing(column, f"{column}_{agg}_{name}", rows, current, agg)
    for column in ("value", "amount", "half")
    for agg in AGGREGATES
    for name, (rows, current) in FRAMES.items()
    if name in ("ub", "last6_now") or (column, agg) == ("value", "avg")
]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("stretch", [1, 700, 100_000])
def test_trailing_over_groups_of_any_size(skewed, stretch):
    plain = trailing(skewed, SPECS, ["key"], ["at", "id"])
    cut = trailing(skewed, SPECS, ["key"], ["at", "id"], any_size=True, stretch=stretch)
    assert [(f.name, f.dataType) for f in cut.schema] == [(f.name, f.dataType) for f in plain.schema]
    assert rows_of(cut) == rows_of(plain)


def test_unknown_aggregates_are_refused_at_once():
    with pytest.raises(ValueError, match="none of"):
        Trailing("value", "x", agg="median")


def test_ranks_over_groups_of_any_size(skewed):
    orders = {"up": [F.asc_nulls_last("value"), F.asc("id")], "down": [F.desc_nulls_last("value"), F.asc("id")]}
    small = skewed.select("key", "id", "value")
    assert rows_of(ranked(small, ["key"], orders, any_size=True)) == rows_of(ranked(small, ["key"], orders))


def test_numbers_by_range_match_row_numbers(skewed):
    order = [F.asc("at"), F.asc("id")]
    want = skewed.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy(*order)).cast("long"))
    assert rows_of(numbered_by_range(skewed, ["key"], order, "n")) == rows_of(want)


def test_dense_id_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 5000, 1, 7).select(((F.col("id") * 7919) % 5000).alias("x"))
        got = dense_id(df, ["x"], "n")
        assert got.where("n <> x + 1").count() == 0
        assert got.count() == 5000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_dense_id_puts_null_last(spark):
    df = spark.createDataFrame([(None, "a"), (2, "b"), (1, "c")], "x int, y string")
    assert sorted(map(tuple, dense_id(df, ["x"], "n").collect())) == [(1, 1, "c"), (2, 2, "b"), (3, None, "a")]


def test_copies_of_one_row_are_spread_and_numbered(spark):
    """A third of the rows are one and the same row; ids stay dense."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("int").alias("x"))
        numbered = dense_id(df, ["x"], "n")
        ids = [r.n for r in numbered.orderBy("n").collect()]
        assert ids == list(range(1, 3001))
        copies = [r.n for r in numbered.where("x = 7").collect()]
        assert max(copies) - min(copies) + 1 == len(copies) == 1001
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
