"""The same person in two sources: exact, carried over, fuzzy, reviewed, given by hand."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.seasons import season_start
from touchline.operators.joins import fill_from_previous
from touchline.operators.matching import (
    MATCH_THRESHOLD,
    apply_overrides,
    final_id_map,
    fuzzy_best,
    id_for_match,
    review_queue,
    with_name_forms,
    with_split_name,
)
from touchline.operators.ranking import keep_first
from touchline.session import written
from touchline.sources.pages import ids_from_links, page_links

PLAYER_LINK = "/en/players/"


@dataclass
class Identities:
    final: DataFrame
    missing: DataFrame
    by_last_name: DataFrame
    by_first_name: DataFrame


def match_people(
    people: DataFrame,
    ids: DataFrame,
    previous: DataFrame | None = None,
    overrides: DataFrame | None = None,
    threshold: int = MATCH_THRESHOLD,
) -> Identities:
    """Id map of ``people`` (first_name, second_name, id) against ``ids`` (name, id).

    ``previous`` is an earlier result; ``overrides`` has (full_name_full, link).
    People still without an id come with two queues of candidates for review.
    """
    people = with_name_forms(people.withColumnRenamed("id", "id_fpl"))
    known = with_split_name(ids).withColumnRenamed("id", "id_fbref")
    merged = people.join(known, ["first_name", "second_name"], "left")
    if previous is not None:
        before = previous.select(
            F.col("first_name_fpl").alias("first_name"), F.col("second_name_fpl").alias("second_name"), "id_fbref"
        )
        merged = fill_from_previous(merged, before, ["first_name", "second_name"], "id_fbref")
    matched, unmatched = merged.where("id_fbref IS NOT NULL"), merged.where("id_fbref IS NULL")

    fuzzy = fuzzy_best(unmatched, ids, "full_name_abbr", "name", threshold).drop("score")
    # Queues, result and missing list all start here; the matching must not run once for each.
    unmatched = written(id_for_match(unmatched.join(fuzzy, "full_name_abbr", "left"), ids), "unmatched")
    open_people = unmatched.where("fuzzy_match IS NULL")
    taken = unmatched.where("fuzzy_match IS NOT NULL")
    by_last = review_queue(open_people, ids, taken, "last", ranked=True)
    by_first = review_queue(open_people, ids, taken, "first", ranked=False)
    if overrides is not None:
        unmatched = apply_overrides(unmatched, overrides)
    final, missing = final_id_map(unmatched, matched)
    return Identities(final, missing, by_last, by_first)


def page_id_list(pages: DataFrame, marker: str = PLAYER_LINK) -> DataFrame:
    """(name, id) of the people linked from team pages."""
    return ids_from_links(page_links(pages, marker))


def earlier_id_list(id_lists: DataFrame, season: str) -> DataFrame:
    """One id per name from the lists (season, name, id) up to ``season``, the earliest first."""
    upto = id_lists.where(season_start(F.col("season")) <= int(season[:4]))
    return keep_first(upto, ["name"], [season_start(F.col("season")), F.asc("id")]).select("name", "id")


