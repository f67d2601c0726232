"""Name and link texts."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def fold_accents(text: pd.Series) -> pd.Series:
    """Compatibility decomposition without combining marks. Spark has no built-in for it."""

    def fold(value: str | None) -> str | None:
        if value is None or value.isascii():
            return value
        return "".join(c for c in unicodedata.normalize("NFKD", value) if not unicodedata.combining(c))

    return text.map(fold, na_action="ignore")


def token(text: Column, n: int) -> Column:
    """n-th blank-separated token from 1, or from the end for negative n; empty when absent."""
    return F.split_part(text, F.lit(" "), F.lit(n))


def split_once(text: Column) -> tuple[Column, Column]:
    """First token and the rest after the first blank (NULL when there is none)."""
    parts = F.split(text, " ", 2)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def full_name(first: Column, last: Column) -> Column:
    """First and last name; NULL if either is NULL."""
    return F.concat(first, F.lit(" "), last)


def short_name(first: Column, last: Column) -> Column:
    """First token of the first name and last token of the last name."""
    return F.concat(token(first, 1), F.lit(" "), token(last, -1))


def match_key(name: Column, fold: bool = True) -> Column:
    """Comparable form: accents folded, lower case, tokens sorted."""
    text = F.lower(fold_accents(name) if fold else name)
    return F.array_join(F.sort_array(F.split(text, " ")), " ")


def similarity(a: Column, b: Column) -> Column:
    """0 to 100 from the edit distance over the longer length."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.round(F.lit(100) * (F.lit(1) - F.try_divide(F.levenshtein(a, b), longer))).cast("int")


def slug_to_text(text: Column) -> Column:
    return F.replace(text, F.lit("-"), F.lit(" "))


def text_to_slug(text: Column, mark: str = "-") -> Column:
    return F.replace(text, F.lit(" "), F.lit(mark))


def file_key(first: Column, last: Column) -> Column:
    """First name and last name joined by underscores, as in folder names."""
    return F.concat(first, F.lit("_"), text_to_slug(last, "_"))


def url_path(url: Column) -> Column:
    """Path of an absolute URL or of a bare path, without query and fragment."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)?([^?#]*)", 1)


def url_segment(url: Column, index: int) -> Column:
    """Segment of the path split at slashes, from 0 as the text before the first slash; NULL if absent."""
    return F.get(F.split(url_path(url), "/"), F.lit(index))


def link_id(url: Column) -> Column:
    """Id in a link of exactly five path parts, else NULL."""
    parts = F.split(url_path(url), "/")
    return F.when(F.size(parts) == 5, F.get(parts, F.lit(3)))


def link_name(url: Column) -> Column:
    """Name in a link of exactly five path parts, dashes as blanks, else NULL."""
    parts = F.split(url_path(url), "/")
    return F.when(F.size(parts) == 5, slug_to_text(F.get(parts, F.lit(4))))


def round_number(text: Column) -> Column:
    """Trailing number of a round label; NULL when the last token is not a number."""
    return token(text, -1).try_cast("int")
