"""Trailing aggregates over ordered groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from touchline.operators.skew import bounded_broadcast, join_same_keys, numbered_by_range
from touchline.session import written

AGGREGATES = ("sum", "avg", "count", "min", "max")
# Rows of a group that one task orders when nothing bounds the group.
STRETCH = 100_000


@dataclass(frozen=True)
class Trailing:
    """One trailing aggregate.

    ``rows`` is the number of preceding rows, None for all of them. With
    ``current`` the current row counts as well, so the frame has rows + 1 rows.
    """

    column: str
    name: str
    rows: int | None = None
    current: bool = False
    agg: str = "sum"

    def __post_init__(self) -> None:
        if self.agg not in AGGREGATES:
            raise ValueError(f"{self.agg} is none of {', '.join(AGGREGATES)}")

    def over(self, window: WindowSpec) -> Column:
        start = Window.unboundedPreceding if self.rows is None else -self.rows
        return getattr(F, self.agg)(self.column).over(window.rowsBetween(start, 0 if self.current else -1))


def trailing(
    df: DataFrame,
    specs: Sequence[Trailing],
    partition_by: Sequence[str],
    order_by: Sequence[str],
    any_size: bool = False,
    stretch: int = STRETCH,
) -> DataFrame:
    """Add all trailing aggregates over one partitioning and order.

    ``order_by`` has to be a total order inside a group. Groups that their grain
    bounds take one exchange and one sort. With ``any_size`` every group is cut into
    stretches of ``stretch`` rows, so a key that holds most rows is many tasks; the
    types are the same, and so are the values but for the order in which doubles
    add up.
    """
    order = [F.col(c).asc_nulls_last() for c in order_by]
    if any_size:
        return _trailing_by_stretch(df, specs, partition_by, order, stretch)
    return _with_windows(df, specs, partition_by, order)


def _with_windows(df: DataFrame, specs: Sequence[Trailing], keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({s.name: s.over(window) for s in specs})


def _trailing_by_stretch(
    df: DataFrame, specs: Sequence[Trailing], keys: Sequence[str], order: Sequence[Column], length: int
) -> DataFrame:
    """The same aggregates for groups cut into stretches of equal length.

    A bounded frame reaches at most some stretches back, so the last rows of each
    are copied to the next one, which has to be as long as the frame. An unbounded
    frame is the aggregate inside the stretch joined with that of all earlier ones.
    """
    reach = max([s.rows for s in specs if s.rows is not None], default=0)
    length = max(length, reach, 1)
    types = {f.name: f.dataType for f in _with_windows(df, specs, keys, order).schema.fields}
    stretch = F.floor((F.col("_pos") - 1) / length)
    numbered = numbered_by_range(df, keys, order, "_pos").withColumn("_stretch", stretch)

    own = F.struct(F.col("_stretch").alias("stretch"), F.lit(False).alias("copied"))
    onward = F.struct((F.col("_stretch") + 1).alias("stretch"), F.lit(True).alias("copied"))
    near_end = F.pmod(F.col("_pos") - 1, F.lit(length)) >= length - reach
    rows = (
        numbered.withColumn("_at", F.explode(F.when(near_end, F.array(own, onward)).otherwise(F.array(own))))
        .withColumn("_stretch", F.col("_at.stretch"))
        .withColumn("_copied", F.col("_at.copied"))
        .drop("_at")
    )

    window = Window.partitionBy(*keys, "_stretch").orderBy("_pos")
    unbounded = [s for s in specs if s.rows is None]
    # An average joins as a sum and a count.
    needed = sorted({(s.column, agg, s.current) for s in unbounded for agg in _parts(s.agg)})
    place = {part: i for i, part in enumerate(needed)}
    running: dict[str, Column] = {s.name: s.over(window) for s in specs if s.rows is not None}
    for (column, agg, current), i in place.items():
        frame = window.rowsBetween(Window.unboundedPreceding, 0 if current else -1)
        running[f"_in{i}"] = getattr(F, agg)(F.when(~F.col("_copied"), F.col(column))).over(frame)
    rows = rows.withColumns(running).where(~F.col("_copied"))

    if unbounded:
        earlier = Window.partitionBy(*keys).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
        whole = [getattr(F, agg)(column).alias(f"_all{i}") for (column, agg, _), i in place.items()]
        # One row per stretch.
        before = numbered.groupBy(*keys, "_stretch").agg(*whole)
        before = before.select(
            *keys, "_stretch", *[_over_parts(agg, f"_all{i}").over(earlier).alias(f"_ago{i}") for (_, agg, _), i in place.items()]
        )
        rows = join_same_keys(rows, bounded_broadcast(written(before, "before")), [*keys, "_stretch"])
        final = {}
        for s in unbounded:
            joined = {}
            for agg in _parts(s.agg):
                i = place[s.column, agg, s.current]
                joined[agg] = _joined(agg, F.col(f"_in{i}"), F.col(f"_ago{i}"))
            if s.agg == "avg":
                # Sums in the type of a plain sum leave the quotient enough digits.
                plain_sum = df.select(F.sum(s.column).alias("s")).schema[0].dataType
                final[s.name] = F.try_divide(joined["sum"].cast(plain_sum), joined["count"])
            else:
                final[s.name] = joined[s.agg]
        rows = rows.withColumns(final)
    return rows.select(*df.columns, *[F.col(s.name).cast(types[s.name]).alias(s.name) for s in specs])


def _parts(agg: str) -> tuple[str, ...]:
    return ("sum", "count") if agg == "avg" else (agg,)


def _over_parts(agg: str, column: str) -> Column:
    """Joins the aggregates of several stretches."""
    return {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}[agg](column)


def _joined(agg: str, inside: Column, ago: Column) -> Column:
    """An aggregate of a stretch's rows and that of the earlier stretches; NULL only if both are."""
    if agg == "count":
        return inside + F.coalesce(ago, F.lit(0))
    if agg == "sum":
        return F.when(inside.isNull(), ago).when(ago.isNull(), inside).otherwise(inside + ago)
    return F.least(inside, ago) if agg == "min" else F.greatest(inside, ago)


def rolling(
    df: DataFrame,
    cols: Mapping[str, str] | Sequence[str],
    partition_by: Sequence[str],
    order_by: Sequence[str],
    n: int | None = None,
    include_current: bool = False,
    agg: str = "sum",
    name: str = "rolling_{}",
    any_size: bool = False,
) -> DataFrame:
    """One trailing frame over several columns; ``cols`` may map a column to its label."""
    labels = dict(cols) if isinstance(cols, Mapping) else {c: c for c in cols}
    specs = [Trailing(c, name.format(label), n, include_current, agg) for c, label in labels.items()]
    return trailing(df, specs, partition_by, order_by, any_size)


def rolling_mean(
    df: DataFrame,
    cols: Sequence[str],
    partition_by: Sequence[str],
    order_by: Sequence[str],
    window: int,
    name: str,
    any_size: bool = False,
) -> DataFrame:
    """Mean of the last ``window`` rows with the current one; shorter histories count too."""
    return rolling(df, cols, partition_by, order_by, window - 1, True, "avg", name, any_size)


def carry_to_next_period(df: DataFrame, period: str) -> DataFrame:
    """Label each row's values with the following period."""
    return df.withColumn(period, F.col(period) + 1)
