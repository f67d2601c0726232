"""Name matching between two sources.

Names are made comparable once and reduced to distinct texts before any pairs
are formed, so copies of a name never multiply.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.names import (
    file_key,
    fold_accents,
    full_name,
    link_id,
    link_name,
    match_key,
    short_name,
    similarity,
    split_once,
    token,
)
from touchline.operators.ranking import first_rows, keep_first
from touchline.session import written

# Least score of a match, length of a ranked candidate list.
MATCH_THRESHOLD = 95
LIST_LENGTH = 5

# Texts with more possible edits than this are blocked by segments instead of deletions.
MAX_DELETIONS = 2

# Keeps bounds on the safe side of binary fractions.
ROUNDING = 1e-9


def _edits(length: Column, threshold: int) -> Column:
    """Most edits a pair with this longer length may have: its score must still round to ``threshold``."""
    return F.floor(length * F.lit((100 - threshold + 0.5) / 100) + ROUNDING).cast("int")


def _longest_partner(length: Column, threshold: int) -> Column:
    """Greatest length a matching partner of a text of this length can have."""
    keep = (threshold - 0.5) / 100
    return F.floor(length / F.lit(keep) + ROUNDING).cast("int")


def _longest_by_deletions(threshold: int) -> int:
    """Greatest length at which no more than ``MAX_DELETIONS`` edits are allowed."""
    return math.ceil((MAX_DELETIONS + 1) / ((100 - threshold + 0.5) / 100) - ROUNDING) - 1


def _with_deletions(text: Column, edits: Column) -> Column:
    """The text with up to ``edits`` characters left out, each form once."""

    def shorter(t: Column) -> Column:
        positions = F.when(F.length(t) > 0, F.sequence(F.lit(1), F.length(t)))
        return F.transform(
            F.coalesce(positions, F.array().cast("array<int>")),
            lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t))),
        )

    forms = F.array(text)
    for step in range(1, MAX_DELETIONS + 1):
        more = F.array_distinct(F.concat(forms, F.flatten(F.transform(forms, shorter))))
        forms = F.when(edits >= step, more).otherwise(forms)
    return forms


def _segment_blocks(text: Column, other: Column, edits: Column) -> Column:
    """Blocks (other length, edits, number, segment) of a text cut into edits + 1 even segments."""
    own = F.length(text)
    pieces = edits + 1

    def cut(i: Column) -> Column:
        start = F.floor(own * i / pieces).cast("int")
        stop = F.floor(own * (i + 1) / pieces).cast("int")
        return F.concat_ws(
            ":", own.cast("string"), other.cast("string"), i.cast("string"), F.substring(text, start + 1, stop - start)
        )

    return F.transform(F.sequence(F.lit(0), edits), cut)


def _substring_blocks(text: Column, other: Column, edits: Column) -> Column:
    """The blocks of a partner of length ``other`` that this text can share.

    With the first unharmed segment being number i, at most i edits lie before it
    and at most edits - i after it, which bounds how far it can have moved.
    """
    own = F.length(text)
    pieces = edits + 1
    longer_by = own - other

    def near(i: Column) -> Column:
        start = F.floor(other * i / pieces).cast("int")
        stop = F.floor(other * (i + 1) / pieces).cast("int")
        size = stop - start
        low = F.greatest(-i, longer_by - edits + i, -start)
        high = F.least(i, longer_by + edits - i, own - size - start)
        return F.transform(
            F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>")),
            lambda shift: F.concat_ws(
                ":",
                other.cast("string"),
                own.cast("string"),
                i.cast("string"),
                F.substring(text, start + shift + 1, size),
            ),
        )

    return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), edits), near)))


def candidate_pairs(left: DataFrame, right: DataFrame, key: str, threshold: int) -> DataFrame:
    """Distinct pairs of texts (``left_key``, ``right_key``) that may score at least ``threshold``.

    No pair that qualifies is missed. Two texts within e edits share a form with at
    most e characters left out, and few distinct texts share such a form, so no
    block grows with the data. Pairs long enough to allow more edits than
    ``MAX_DELETIONS`` must share one of e + 1 segments at nearly the same place.
    """
    length = F.length(key)
    if not 1 <= threshold <= 100:
        raise ValueError("threshold must lie between 1 and 100")

    def texts(df: DataFrame) -> DataFrame:
        distinct = df.select(key).where(length > 0).distinct()
        return distinct.withColumn("_longest", _longest_partner(length, threshold))

    left, right = texts(left), texts(right)

    def by_deletions(df: DataFrame, name: str) -> DataFrame:
        edits = F.least(_edits(F.col("_longest"), threshold), F.lit(MAX_DELETIONS))
        return df.where(_edits(length, threshold) <= MAX_DELETIONS).select(
            F.col(key).alias(name), F.explode(_with_deletions(F.col(key), edits)).alias("_block")
        )

    def by_segments(df: DataFrame, name: str, blocks, others: list[int]) -> DataFrame:
        shortest = F.ceil(length * F.lit((threshold - 0.5) / 100) - ROUNDING).cast("int")
        other = df.where(_edits(F.col("_longest"), threshold) > MAX_DELETIONS).withColumn(
            "_other", F.explode(F.sequence(shortest, F.col("_longest")))
        )
        edits = _edits(F.greatest(length, F.col("_other")), threshold)
        return (
            other.where(F.col("_other").isin(others))
            .withColumn("_edits", edits)
            .where(F.col("_edits") > MAX_DELETIONS)
            .select(F.col(key).alias(name), F.explode(blocks(F.col(key), F.col("_other"), F.col("_edits"))).alias("_block"))
        )

    def lengths(df: DataFrame) -> list[int]:
        """Text lengths that occur; one row per length is read."""
        return [row[0] for row in df.select(length).distinct().collect()]

    near = by_deletions(left, "left_key").join(by_deletions(right, "right_key"), "_block")
    left_lengths, right_lengths = lengths(left), lengths(right)
    if max([*left_lengths, *right_lengths], default=0) <= _longest_by_deletions(threshold):
        return near.select("left_key", "right_key").distinct()
    far = by_segments(left, "left_key", _segment_blocks, right_lengths).join(
        by_segments(right, "right_key", _substring_blocks, left_lengths), "_block"
    )
    return near.unionByName(far).select("left_key", "right_key").distinct()


def fuzzy_best(
    left: DataFrame, right: DataFrame, name: str, choice: str, threshold: int = MATCH_THRESHOLD, fold: bool = True
) -> DataFrame:
    """Best choice for each distinct name: (name, fuzzy_match, score), only where the score is reached.

    Equal scores go to the choice that sorts first.
    """
    names = left.select(name).where(F.col(name).isNotNull()).distinct()
    choices = right.select(F.col(choice).alias("fuzzy_match")).where(F.col(choice).isNotNull()).distinct()
    choices = choices.withColumn("right_key", match_key(F.col("fuzzy_match"), fold))
    # One choice stands for all that compare equal. Both lists are used several
    # times below, so their accents are folded once and written.
    choices = written(choices.groupBy("right_key").agg(F.min("fuzzy_match").alias("fuzzy_match")), "choices")
    names = written(names.withColumn("left_key", match_key(F.col(name), fold)), "names")
    pairs = candidate_pairs(
        names.withColumnRenamed("left_key", "_key"), choices.withColumnRenamed("right_key", "_key"), "_key", threshold
    )
    scored = pairs.withColumn("score", similarity(F.col("left_key"), F.col("right_key"))).where(F.col("score") >= threshold)
    scored = scored.join(choices, "right_key")
    best = keep_first(scored, ["left_key"], [F.desc("score"), F.asc("fuzzy_match")])
    return names.join(best, "left_key").select(name, "fuzzy_match", "score")


def first_id(ids: DataFrame, name: str, id_col: str, order: Sequence[Column] | None = None) -> DataFrame:
    """One id per name, the first in ``order``."""
    return keep_first(ids, [name], order or [F.col(id_col).asc()])


def id_for_match(df: DataFrame, ids: DataFrame, name: str = "name", id_col: str = "id", target: str = "id_fbref") -> DataFrame:
    """Fill ``target`` with the id of the matched name; rows without a match keep theirs."""
    first = first_id(ids, name, id_col).select(F.col(name).alias("fuzzy_match"), F.col(id_col).alias("_id"))
    joined = df.join(first, "fuzzy_match", "left")
    return joined.withColumn(target, F.coalesce("_id", target)).select(*df.columns)


def review_queue(
    missing: DataFrame,
    ids: DataFrame,
    taken: DataFrame,
    use: str = "last",
    ranked: bool = True,
    first: str = "first_name",
    last: str = "second_name",
    name: str = "name",
    limit: int = LIST_LENGTH,
) -> DataFrame:
    """Candidates for people without a match: names holding their last or first name, not yet taken.

    Ranked: (first, last, candidate, score, choice), the ``limit`` most similar.
    Unranked: (token, candidate), once per distinct token however many people share
    it; join people on the token to list theirs.
    """
    whole = F.col(first) if use == "first" else F.col(last)
    part = F.lower(fold_accents(whole if use == "first" else token(whole, -1)))
    people = missing.select(first, last).distinct().withColumn("token", part).where(F.length("token") > 0)
    free = ids.select(F.col(name).alias("candidate")).distinct()
    free = free.join(taken.select(F.col("fuzzy_match").alias("candidate")).distinct(), "candidate", "left_anti")

    # A name holds the token iff the token is one of its substrings: an equi join.
    # Only lengths that occur among the tokens are cut; one row per length is read.
    tokens = people.select("token").distinct()
    lengths = sorted(r[0] for r in tokens.select(F.length("token")).distinct().collect())
    text = F.lower("candidate")
    empty = F.array().cast("array<string>")

    def cuts(size: int) -> Column:
        starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1))
        return F.coalesce(F.transform(starts, lambda i: F.substring(text, i, F.lit(size))), empty)

    held = F.array_distinct(F.flatten(F.array(*[cuts(size) for size in lengths]))) if lengths else empty
    holders = free.select("candidate", F.explode(held).alias("token")).join(tokens, "token", "left_semi")
    if not ranked:
        return holders.select("token", "candidate")
    # The score depends on the compared text alone, so people who share it are ranked once. Keys are made
    # once per text and candidate, before any pair is formed.
    texts = people.select(whole.alias("_text"), "token").distinct().withColumn("_key", match_key(F.col("_text")))
    keys = written(free.select("candidate", match_key(F.col("candidate")).alias("_other")), "candidate-keys")
    scored = texts.join(holders.join(keys, "candidate"), "token").withColumn("score", similarity(F.col("_key"), F.col("_other")))
    best = first_rows(scored, ["_text"], [F.desc("score"), F.asc("candidate")], limit, "choice")
    return people.withColumn("_text", whole).join(best, "_text").select(first, last, "candidate", "score", "choice")


def apply_overrides(df: DataFrame, overrides: DataFrame, person: str = "full_name_full", link: str = "link") -> DataFrame:
    """Ids and names from hand-given links for people still without an id; other rows stay."""
    given = overrides.select(
        F.col(person), link_id(F.col(link)).alias("_id"), link_name(F.col(link)).alias("_name")
    ).where(F.col("_id").isNotNull())
    joined = df.join(given, person, "left")
    open_row = F.col("id_fbref").isNull()
    return (
        joined.withColumn("fuzzy_match", F.when(open_row, F.coalesce("_name", "fuzzy_match")).otherwise(F.col("fuzzy_match")))
        .withColumn("id_fbref", F.coalesce("id_fbref", "_id"))
        .select(*df.columns)
    )


def with_name_forms(people: DataFrame) -> DataFrame:
    """Adds full and abbreviated names and the key used in folder names."""
    first, last = F.col("first_name"), F.col("second_name")
    return people.withColumns(
        {
            "full_name_abbr": short_name(first, last),
            "full_name_full": full_name(first, last),
            "file_key": file_key(first, last),
        }
    )


def with_split_name(ids: DataFrame, name: str = "name") -> DataFrame:
    first, rest = split_once(F.col(name))
    return ids.withColumn("first_name", first).withColumn("second_name", rest)


def final_id_map(unmatched: DataFrame, matched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All people with their ids where known, and the names of those still missing.

    ``matched`` has (first_name, second_name, name, id_fpl, id_fbref); ``unmatched``
    also ``fuzzy_match`` and ``full_name_full``. Direct matches win over recovered
    ones for the same person.
    """
    columns = ["first_name", "second_name", "name", "id_fpl", "id_fbref"]
    person = ["first_name", "second_name", "id_fpl"]
    recovered = unmatched.where(F.col("id_fbref").isNotNull()).withColumn("name", F.col("fuzzy_match"))
    both = matched.select(*columns, F.lit(0).alias("_source")).unionByName(
        recovered.select(*columns, F.lit(1).alias("_source"))
    )
    found = keep_first(both, ["id_fpl"], [F.asc("_source"), F.asc("id_fbref"), F.asc("name")]).drop("_source")
    everyone = found.select(*person).unionByName(unmatched.select(*person)).distinct()
    final = everyone.join(found, person, "left").select(
        F.col("first_name").alias("first_name_fpl"),
        F.col("second_name").alias("second_name_fpl"),
        "id_fpl",
        F.col("name").alias("name_fbref"),
        "id_fbref",
    )
    missing = unmatched.where(F.col("id_fbref").isNull()).select("full_name_full")
    return final, missing
