"""Joins of the sports schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.columns import open_end


def unpivot_sides(
    df: DataFrame, id_cols: Sequence[str], sides: Mapping[str, Mapping[str, str]], side: str = "side"
) -> DataFrame:
    """One row per side from one scan: ``sides={"home": {label: source, ..}, "away": {..}}``."""
    rows = [
        F.struct(F.lit(name).alias(side), *[F.col(source).alias(label) for label, source in cols.items()])
        for name, cols in sides.items()
    ]
    return df.select(*id_cols, F.inline(F.array(*rows)))


def either_side(matches: DataFrame, home: str, away: str, key: str, side: str = "side") -> DataFrame:
    """Matches once per team in them, with the team in ``key`` and its opponent in ``opponent_<key>``.

    An equi join on ``key`` then equals the join "team is home OR away": a match of
    a team with itself keeps one row.
    """
    others = [c for c in matches.columns]
    rows = unpivot_sides(
        matches,
        others,
        {
            "home": {key: home, f"opponent_{key}": away},
            "away": {key: away, f"opponent_{key}": home},
        },
        side,
    )
    return rows.where((F.col(side) == "home") | ~F.col(home).eqNullSafe(F.col(away)))


def role_playing(df: DataFrame, dim: DataFrame, roles: Mapping[str, str], key: str, attributes: Sequence[str]) -> DataFrame:
    """Join one dimension several times: ``roles={prefix: key column}`` adds ``<prefix>_<attribute>``."""
    for prefix, column in roles.items():
        view = dim.select(F.col(key).alias(column), *[F.col(a).alias(f"{prefix}_{a}") for a in attributes])
        df = df.join(view, column)
    return df


def valid_at(
    facts: DataFrame,
    intervals: DataFrame,
    key: str | Sequence[str],
    at: str,
    start: str = "start_date",
    end: str = "end_date",
) -> DataFrame:
    """Facts with the intervals holding at their time; an open end lasts forever.

    Hash or merge join on the key with the range as residual. Skewed fact keys are
    split by the adaptive skew join, as a key has few intervals.
    """
    keys = [key] if isinstance(key, str) else list(key)
    spans = intervals.withColumnsRenamed({k: f"_span_{k}" for k in keys})
    same = [F.col(k) == F.col(f"_span_{k}") for k in keys]
    inside = F.col(at).cast("timestamp").between(F.col(start).cast("timestamp"), open_end(F.col(end)))
    return facts.join(spans, [*same, inside]).drop(*[f"_span_{k}" for k in keys])


def latest_attribute(
    df: DataFrame, history: DataFrame, key: str, period: str, attributes: Sequence[str]
) -> DataFrame:
    """Left join to the attributes of the rows of the latest period."""
    latest = history.where(F.col(period) == history.agg(F.max(period)).scalar())
    return df.join(latest.select(key, *attributes), key, "left")


def split_matched(left: DataFrame, right: DataFrame, on: Sequence[str], found: str) -> tuple[DataFrame, DataFrame]:
    """Left join on equal names, split into rows with and without ``found``."""
    joined = left.join(right, list(on), "left")
    return joined.where(F.col(found).isNotNull()), joined.where(F.col(found).isNull())


def fill_from_previous(df: DataFrame, previous: DataFrame, on: Sequence[str], value: str) -> DataFrame:
    """Missing values taken from the previous period's result."""
    before = previous.select(*on, F.col(value).alias("_previous"))
    filled = df.join(before, list(on), "left").withColumn(value, F.coalesce(value, "_previous"))
    return filled.select(*df.columns)


def keep_keys(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(keys, on, "left_semi")


def drop_keys(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(keys, on, "left_anti")


def on_same_day(a: Column, b: Column) -> Column:
    return F.to_date(a) == F.to_date(b)
