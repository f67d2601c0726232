"""Season labels such as 2024-25."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIRST_MONTH = 8
SEASON_FORMAT = r"^\d{4}-\d{2}$"


def _label(start_year: Column) -> Column:
    return F.format_string("%d-%02d", start_year, F.pmod(start_year + 1, F.lit(100)))


def season_of(date: Column, first_month: int = FIRST_MONTH) -> Column:
    """Season of a date; a season begins in August."""
    start = F.year(date) - F.when(F.month(date) >= first_month, 0).otherwise(1)
    return F.when(date.isNotNull(), _label(start))


def season_start(season: Column) -> Column:
    return F.substring(season, 1, 4).cast("int")


def season_end(season: Column) -> Column:
    """The first year after the start that ends in the label's last two digits."""
    start = season_start(season)
    return start + F.pmod(F.substring(season, 6, 2).cast("int") - start, F.lit(100))


def previous_season(season: Column) -> Column:
    """Both years less one, the end year by its last two digits."""
    before = F.pmod(F.substring(season, 6, 2).cast("int") - 1, F.lit(100))
    return F.when(season.isNotNull(), F.format_string("%d-%02d", season_start(season) - 1, before))


def long_season(season: Column) -> Column:
    """2024-25 -> 2024-2025."""
    return F.concat(F.substring(season, 1, 5), season_end(season))


def is_season(text: Column) -> Column:
    return text.rlike(SEASON_FORMAT)
