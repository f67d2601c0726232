"""Column functions: ratios, decoding, clean-up, selection by type."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Position codes and names, points per goal by position, points per assist.
POSITIONS = {"1": "GK", "2": "DEF", "3": "MID", "4": "FWD"}
GOAL_POINTS = {"FWD": 4, "MID": 5, "DEF": 6}
ASSIST_POINTS = 3
FAR_FUTURE = "9999-12-31"


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def safe_ratio(num: Column, den: Column, coalesce: bool = True) -> Column:
    """num / den where den > 0, else 0; without ``coalesce`` a NULL numerator stays NULL."""
    if coalesce:
        num, den = zero_if_null(num), zero_if_null(den)
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def rate_per(num: Column, exposure: Column, per: int = 90) -> Column:
    """num per ``per`` units of exposure, 0 without exposure."""
    exposure = zero_if_null(exposure).cast("double")
    return F.when(exposure > 0, zero_if_null(num).cast("double") / (exposure / per)).otherwise(F.lit(0.0))


def sum_of(*parts: Column) -> Column:
    """Sum with NULL counted as 0."""
    total = zero_if_null(parts[0])
    for part in parts[1:]:
        total = total + zero_if_null(part)
    return total


def clip_at_zero(value: Column) -> Column:
    """max(value, 0) with NULL kept; ``greatest`` alone would turn NULL into 0."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(0)))


def literal_map(pairs: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def decode(value: Column, codes: Mapping[str, str] = POSITIONS) -> Column:
    """Code to name; an unknown code fails the job."""
    name = F.element_at(literal_map(codes), value.cast("string"))
    unknown = F.raise_error(F.concat(F.lit("unknown code: "), F.coalesce(value.cast("string"), F.lit("NULL"))))
    return F.coalesce(name, unknown.cast("string"))


def flag_to_int(value: Column, yes: str = "Y", no: str = "N") -> Column:
    """Y -> 1, N -> 0, anything else NULL."""
    return F.when(value == yes, 1).when(value == no, 0)


def is_marked(value: Column, marked: str = "Y*") -> Column:
    """1 where the flag carries the mark, else 0 (also for NULL)."""
    return F.when(value == marked, 1).otherwise(0)


def one_if(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def by_side(is_home: Column, home: Column, away: Column) -> Column:
    return F.when(is_home, home).otherwise(away)


def goal_points(position: Column, goals: Column, assists: Column) -> Column:
    """Points by position; positions without a rule get NULL."""
    weight = F.element_at(literal_map(GOAL_POINTS), position)
    return goals * weight + F.when(weight.isNotNull(), assists * ASSIST_POINTS)


def confusion_class(predicted_rank: Column, actual_rank: Column, k: int = 10) -> Column:
    """Four-way class of a prediction by two ranks."""
    hit, wanted = predicted_rank <= k, actual_rank <= k
    return (
        F.when(hit & wanted, "Correctly Predicted")
        .when(hit, "False Positive")
        .when(wanted, "Missed Prediction")
        .otherwise("Correctly Excluded")
    )


def open_end(end: Column) -> Column:
    """Interval end, far future while still open."""
    return F.coalesce(end.cast("timestamp"), F.lit(FAR_FUTURE).cast("timestamp"))


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Select and rename: ``{source: label}`` in output order."""
    return df.select(*[F.col(source).alias(label) for source, label in names.items()])


def columns_of(df: DataFrame, kind: str) -> list[str]:
    """Column names by kind: ``number``, ``string`` or ``boolean``."""
    kinds = {"number": T.NumericType, "string": T.StringType, "boolean": T.BooleanType}
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds[kind])]


def null_sentinel(df: DataFrame, sentinel: str) -> DataFrame:
    """Replace a sentinel text by NULL in every text column."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(sentinel)) for c in columns_of(df, "string")})


def drop_columns(df: DataFrame, names: Sequence[str] = (), positions: Sequence[int] = ()) -> DataFrame:
    """Drop by name, ignoring absent names, and by position."""
    return df.drop(*names, *[df.columns[i] for i in positions])


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def contains_text(value: Column, part: str | Column, ignore_case: bool = False) -> Column:
    """Literal substring test (not a pattern)."""
    part = F.lit(part) if isinstance(part, str) else part
    if ignore_case:
        return F.contains(F.lower(value), F.lower(part))
    return F.contains(value, part)
