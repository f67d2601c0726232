"""Names across two sources.

People are the distinct names of parts. The second source lists every other name
unchanged and the rest with an accent, a swapped token order or a lost letter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.names import (
    file_key,
    fold_accents,
    match_key,
    short_name,
    similarity,
    split_once,
)
from touchline.operators.matching import (
    apply_overrides,
    final_id_map,
    fuzzy_best,
    id_for_match,
    review_queue,
)
from touchline.operators.ranking import keep_first
from touchline.plans.identity import earlier_id_list, match_people
from touchline.queries.registry import query, table


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct part names with brand and type, the smallest key as id."""
    part = table(spark, sf_dir, "part")
    name = F.concat_ws(" ", "p_name", "p_type", "p_brand")
    return part.groupBy(name.alias("name")).agg(F.min("p_partkey").alias("id"))


PARTS_SQL = "SELECT p_name || ' ' || p_type || ' ' || p_brand AS name, MIN(p_partkey) AS id FROM part GROUP BY 1"


def _spelling(name, id_col):
    """The name as another source may write it."""
    tokens = F.split(name, " ")
    return (
        F.when(id_col % 4 == 1, F.concat(F.substring(name, F.lit(1), id_col % 7 + 2), F.substring(name, (id_col % 7 + 4).cast("int"), F.length(name))))
        .when(id_col % 4 == 2, F.concat_ws(" ", F.get(tokens, F.lit(1)), F.get(tokens, F.lit(0)), F.get(tokens, F.lit(2)), F.get(tokens, F.lit(3))))
        .when(id_col % 4 == 3, F.regexp_replace(name, "e", "é"))
        .otherwise(name)
    )


SPELLING_SQL = """
    CASE id % 4 WHEN 1 THEN substr(name, 1, CAST(id % 7 + 2 AS INTEGER)) || substr(name, CAST(id % 7 + 4 AS INTEGER))
         WHEN 2 THEN split_part(name, ' ', 2) || ' ' || split_part(name, ' ', 1) || ' ' || split_part(name, ' ', 3) || ' ' || split_part(name, ' ', 4)
         WHEN 3 THEN replace(name, 'e', 'é') ELSE name END
"""


def _spelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _parts(spark, sf_dir)
    spelled = parts.select(_spelling(F.col("name"), F.col("id").cast("int")).alias("spelled"), "id")
    return spelled.groupBy("spelled").agg(F.min("id").alias("id"))


SPELLED_SQL = f"SELECT {SPELLING_SQL} AS spelled, MIN(id) AS id FROM ({PARTS_SQL}) GROUP BY 1"
KEY_SQL = "array_to_string(list_sort(string_split(lower(strip_accents({0})), ' ')), ' ')"
SCORE_SQL = "CAST(ROUND(100 * (1 - levenshtein({0}, {1}) / CAST(GREATEST(length({0}), length({1})) AS DOUBLE))) AS INTEGER)"


@query(
    f"""
    WITH left_names AS (SELECT spelled, {KEY_SQL.format("spelled")} AS lk FROM ({SPELLED_SQL})),
    right_names AS (SELECT {KEY_SQL.format("name")} AS rk, MIN(name) AS name FROM ({PARTS_SQL}) GROUP BY 1),
    scored AS (SELECT spelled, name, {SCORE_SQL.format("lk", "rk")} AS score FROM left_names, right_names
)
    SELECT spelled, name AS fuzzy_match, score FROM scored WHERE score >= 95
    QUALIFY ROW_NUMBER() OVER (PARTITION BY spelled ORDER BY score DESC, name) = 1
    """
)
def fuzzy_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_best(_spelled(spark, sf_dir), _parts(spark, sf_dir), "spelled", "name")


@query(
    f"""
    WITH left_names AS (SELECT spelled, {KEY_SQL.format("spelled")} AS lk FROM ({SPELLED_SQL})),
    right_names AS (SELECT {KEY_SQL.format("name")} AS rk, MIN(name) AS name, MIN(id) AS id FROM ({PARTS_SQL}) GROUP BY 1),
    best AS (
        SELECT spelled, name, score FROM (
            SELECT spelled, name, {SCORE_SQL.format("lk", "rk")} AS score FROM left_names, right_names) WHERE score >= 95
        QUALIFY ROW_NUMBER() OVER (PARTITION BY spelled ORDER BY score DESC, name) = 1)
    SELECT p.id AS id_fpl, p.spelled, best.name AS fuzzy_match, ids.id AS id_fbref
    FROM ({SPELLED_SQL}) p LEFT JOIN best ON best.spelled = p.spelled
    LEFT JOIN (SELECT name, MIN(id) AS id FROM ({PARTS_SQL}) GROUP BY 1) ids ON ids.name = best.name
    """
)
def resolve_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _parts(spark, sf_dir)
    people = _spelled(spark, sf_dir).withColumnRenamed("id", "id_fpl").withColumn("id_fbref", F.lit(None).cast("long"))
    best = fuzzy_best(people, parts, "spelled", "name").drop("score")
    return id_for_match(people.join(best, "spelled", "left"), parts)


# Two-token people for review: first and second word of the spelled name against the words of part names.
def _reviewed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    parts = _parts(spark, sf_dir)
    first, rest = split_once(F.col("spelled"))
    people = _spelled(spark, sf_dir).select(first.alias("first_name"), rest.alias("second_name"))
    taken = parts.where(F.contains("name", F.lit(" PROMO "))).select(F.col("name").alias("fuzzy_match"))
    return people, parts, taken


REVIEW_SQL = f"""
    people AS (SELECT DISTINCT split_part(spelled, ' ', 1) AS first_name, substr(spelled, strpos(spelled, ' ') + 1) AS second_name
               FROM ({SPELLED_SQL})),
    free AS (SELECT DISTINCT name AS candidate FROM ({PARTS_SQL}) WHERE NOT contains(name, ' PROMO '))
"""


@query(
    f"""
    WITH {REVIEW_SQL},
    tokens AS (SELECT *, lower(strip_accents(split_part(second_name, ' ', -1))) AS token FROM people),
    pairs AS (SELECT first_name, second_name, candidate, {KEY_SQL.format("second_name")} AS lk, {KEY_SQL.format("candidate")} AS rk
              FROM tokens JOIN free ON contains(lower(candidate), token) AND token <> ''),
    scored AS (SELECT first_name, second_name, candidate, {SCORE_SQL.format("lk", "rk")} AS score FROM pairs)
    SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY first_name, second_name ORDER BY score DESC, candidate) AS INTEGER) AS choice
    FROM scored QUALIFY choice <= 5
    """
)
def review_queue_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review_queue(*_reviewed(spark, sf_dir), use="last", ranked=True)


@query(
    f"""
    WITH {REVIEW_SQL},
    tokens AS (SELECT DISTINCT lower(strip_accents(first_name)) AS token FROM people)
    SELECT token, candidate FROM tokens JOIN free ON contains(lower(candidate), token) WHERE token <> ''
    """
)
def review_queue_loose(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review_queue(*_reviewed(spark, sf_dir), use="first", ranked=False)


def _linked_people(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Suppliers as people: the rich ones have an id, the indebted ones no link, some nations' links are short."""
    suppliers = table(spark, sf_dir, "supplier")
    people = suppliers.select(
        F.col("s_suppkey").alias("id_fpl"),
        F.col("s_name").alias("full_name_full"),
        F.when(F.col("s_acctbal") > 6000, F.concat(F.lit("known"), F.col("s_suppkey"))).alias("id_fbref"),
        F.lit(None).cast("string").alias("fuzzy_match"),
    )
    short = F.concat(F.lit("https://stats.example.org/en/players/"), F.hex("s_suppkey"))
    links = suppliers.where("s_acctbal >= 0").select(
        F.col("s_name").alias("full_name_full"),
        F.when(F.col("s_nationkey") < 5, short)
        .otherwise(F.concat(short, F.lit("/Person-Number-"), F.col("s_suppkey"), F.lit("?tab=1#top")))
        .alias("link"),
    )
    return people, links


@query(
    """
    SELECT s_suppkey AS id_fpl, s_name AS full_name_full,
           CASE WHEN s_acctbal > 6000 THEN 'known' || s_suppkey
                WHEN s_acctbal >= 0 AND s_nationkey >= 5 THEN upper(printf('%x', s_suppkey)) END AS id_fbref,
           CASE WHEN s_acctbal <= 6000 AND s_acctbal >= 0 AND s_nationkey >= 5
                THEN 'Person Number ' || s_suppkey END AS fuzzy_match
    FROM supplier
    """
)
def override_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_overrides(*_linked_people(spark, sf_dir))


@query(
    """
    WITH found AS (
        SELECT c_custkey AS id_fpl, 'Customer' AS first_name, c_name AS second_name, c_mktsegment AS name, 'a' || c_custkey AS id_fbref, 0 AS source
        FROM customer WHERE c_mktsegment = 'BUILDING'
        UNION ALL
        SELECT c_custkey, 'Customer', c_name, 'fuzzy ' || c_name, 'b' || c_custkey, 1 FROM customer WHERE c_acctbal > 3000),
    kept AS (SELECT * FROM found QUALIFY ROW_NUMBER() OVER (PARTITION BY id_fpl ORDER BY source) = 1)
    SELECT 'Customer' AS first_name_fpl, c_name AS second_name_fpl, c_custkey AS id_fpl, kept.name AS name_fbref, kept.id_fbref
    FROM customer LEFT JOIN kept ON kept.id_fpl = c_custkey
    """
)
def match_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id_fpl"),
        F.lit("Customer").alias("first_name"),
        F.col("c_name").alias("second_name"),
        "c_mktsegment",
        "c_acctbal",
    )
    matched = customers.where("c_mktsegment = 'BUILDING'").select(
        "id_fpl", "first_name", "second_name",
        F.col("c_mktsegment").alias("name"), F.concat(F.lit("a"), F.col("id_fpl")).alias("id_fbref"),
    )
    rich = F.col("c_acctbal") > 3000
    unmatched = customers.select(
        "id_fpl", "first_name", "second_name",
        F.when(rich, F.concat(F.lit("b"), F.col("id_fpl"))).alias("id_fbref"),
        F.when(rich, F.concat(F.lit("fuzzy "), F.col("second_name"))).alias("fuzzy_match"),
        F.concat_ws(" ", "first_name", "second_name").alias("full_name_full"),
    )
    final, _ = final_id_map(unmatched, matched)
    return final


@query(
    f"""
    WITH names AS (SELECT {SPELLING_SQL} AS spelled, id FROM ({PARTS_SQL})),
    parts AS (SELECT id, spelled, split_part(spelled, ' ', 1) AS first_name,
              substr(spelled, strpos(spelled, ' ') + 1) AS second_name FROM names)
    SELECT id, first_name, second_name, first_name || ' ' || split_part(second_name, ' ', -1) AS short,
           first_name || '_' || replace(second_name, ' ', '_') AS file_key, {KEY_SQL.format("spelled")} AS match_key
    FROM parts
    """
)
def name_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _parts(spark, sf_dir).select("id", _spelling(F.col("name"), F.col("id").cast("int")).alias("spelled"))
    first, rest = split_once(F.col("spelled"))
    return names.select("id", "spelled", first.alias("first_name"), rest.alias("second_name")).select(
        "id", "first_name", "second_name",
        short_name(F.col("first_name"), F.col("second_name")).alias("short"),
        file_key(F.col("first_name"), F.col("second_name")).alias("file_key"),
        match_key(F.col("spelled")).alias("match_key"),
    )


@query("SELECT doc_id, length(strip_accents(text)) AS chars, md5(strip_accents(text)) AS digest FROM documents")
def folded_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", fold_accents("text").alias("folded"))
    return documents.select("doc_id", F.length("folded").cast("long").alias("chars"), F.md5(F.encode("folded", "UTF-8")).alias("digest"))


@query(
    f"""
    WITH ids AS (SELECT split_part(name, ' ', 1) || ' ' || split_part(name, ' ', 2) AS name, CAST(1990 + id % 30 AS INTEGER) AS year, CAST(id AS VARCHAR) AS id
                 FROM ({PARTS_SQL}))
    SELECT name, id FROM ids WHERE year <= 2010
    QUALIFY ROW_NUMBER() OVER (PARTITION BY name ORDER BY year, id) = 1
    """
)
def earlier_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _parts(spark, sf_dir)
    tokens = F.split("name", " ")
    year = (F.lit(1990) + F.col("id") % 30).cast("int")
    lists = parts.select(
        F.format_string("%d-%02d", year, (year + 1) % 100).alias("season"),
        F.concat_ws(" ", F.get(tokens, F.lit(0)), F.get(tokens, F.lit(1))).alias("name"),
        F.col("id").cast("string").alias("id"),
    )
    return earlier_id_list(lists, "2010-11")


CASCADE_SQL = f"""
    WITH names AS (SELECT {SPELLING_SQL} AS spelled, id FROM ({PARTS_SQL})),
    people AS (SELECT id, split_part(spelled, ' ', 1) AS first_name, substr(spelled, strpos(spelled, ' ') + 1) AS second_name FROM names),
    ids AS (SELECT name, 'n' || id AS id, split_part(name, ' ', 1) AS first_name, substr(name, strpos(name, ' ') + 1) AS second_name
            FROM ({PARTS_SQL}) WHERE NOT contains(name, ' PROMO ')),
    previous AS (SELECT first_name, second_name, 'p' || MIN(id) AS id FROM people
                 WHERE contains(second_name, 'PROMO Brand#1') GROUP BY 1, 2),
    merged AS (SELECT people.id AS id_fpl, people.first_name, people.second_name, ids.name, COALESCE(ids.id, previous.id) AS id_fbref,
                      people.first_name || ' ' || split_part(people.second_name, ' ', -1) AS abbr
               FROM people LEFT JOIN ids ON ids.first_name = people.first_name AND ids.second_name = people.second_name
               LEFT JOIN previous ON previous.first_name = people.first_name AND previous.second_name = people.second_name),
    choices AS (SELECT {KEY_SQL.format("name")} AS rk, MIN(name) AS name FROM ids GROUP BY 1),
    best AS (
        SELECT abbr, name FROM (
            SELECT abbr, name, {SCORE_SQL.format("lk", "rk")} AS score
            FROM (SELECT DISTINCT abbr, {KEY_SQL.format("abbr")} AS lk FROM merged WHERE id_fbref IS NULL), choices) WHERE score >= 80
        QUALIFY ROW_NUMBER() OVER (PARTITION BY abbr ORDER BY score DESC, name) = 1)
"""


def _cascade_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    parts = _parts(spark, sf_dir)
    names = parts.select("id", _spelling(F.col("name"), F.col("id").cast("int")).alias("spelled"))
    first, rest = split_once(F.col("spelled"))
    people = names.select("id", first.alias("first_name"), rest.alias("second_name"))
    ids = parts.where(~F.contains("name", F.lit(" PROMO "))).select("name", F.concat(F.lit("n"), F.col("id")).alias("id"))
    earlier = keep_first(people.where(F.contains("second_name", F.lit("PROMO Brand#1"))), ["first_name", "second_name"], [F.asc("id")])
    previous = earlier.select(
        F.col("first_name").alias("first_name_fpl"),
        F.col("second_name").alias("second_name_fpl"),
        F.concat(F.lit("p"), F.col("id")).alias("id_fbref"),
    )
    return people, ids, previous


@query(
    f"""
    {CASCADE_SQL}
    SELECT merged.first_name AS first_name_fpl, merged.second_name AS second_name_fpl, id_fpl,
           CASE WHEN id_fbref IS NOT NULL THEN merged.name ELSE best.name END AS name_fbref,
           COALESCE(id_fbref, (SELECT MIN(ids.id) FROM ids WHERE ids.name = best.name)) AS id_fbref
    FROM merged LEFT JOIN best ON best.abbr = merged.abbr AND id_fbref IS NULL
    """
)
def identity_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    people, ids, previous = _cascade_inputs(spark, sf_dir)
    return match_people(people, ids, previous, threshold=80).final


@query(
    f"""
    {CASCADE_SQL},
    open AS (SELECT DISTINCT first_name, second_name, lower(strip_accents(split_part(second_name, ' ', -1))) AS last, lower(strip_accents(first_name)) AS first
             FROM merged LEFT JOIN best USING (abbr) WHERE id_fbref IS NULL AND best.name IS NULL),
    taken AS (SELECT best.name FROM merged JOIN best USING (abbr) WHERE id_fbref IS NULL),
    free AS (SELECT DISTINCT name AS candidate FROM ids WHERE name NOT IN (SELECT name FROM taken)),
    scored AS (
        SELECT first_name, second_name, candidate, {SCORE_SQL.format("lk", "rk")} AS score
        FROM (SELECT *, {KEY_SQL.format("second_name")} AS lk, {KEY_SQL.format("candidate")} AS rk
              FROM open JOIN free ON contains(lower(candidate), last) AND last <> ''))
    SELECT 'last' AS queue, first_name || '|' || second_name AS person, candidate, score,
           CAST(ROW_NUMBER() OVER (PARTITION BY first_name, second_name ORDER BY score DESC, candidate) AS INTEGER) AS choice
    FROM scored QUALIFY choice <= 5
    UNION ALL
    SELECT 'first', first, candidate, NULL, NULL
    FROM (SELECT DISTINCT first FROM open WHERE first <> '') JOIN free ON contains(lower(candidate), first)
    """
)
def cascade_queues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both review queues of the cascade: ranked by last name, and plain by first name."""
    people, ids, previous = _cascade_inputs(spark, sf_dir)
    found = match_people(people, ids, previous, threshold=80)
    last = found.by_last_name.select(
        F.lit("last").alias("queue"), F.concat_ws("|", "first_name", "second_name").alias("person"), "candidate", "score", "choice"
    )
    first = found.by_first_name.select(F.lit("first").alias("queue"), F.col("token").alias("person"), "candidate")
    return last.unionByName(first, allowMissingColumns=True)


@query(
    f"""
    {CASCADE_SQL},
    resolved AS (
        SELECT id_fpl, first_name || ' ' || second_name AS full_name,
               CASE WHEN id_fbref IS NOT NULL THEN merged.name ELSE best.name END AS name,
               COALESCE(id_fbref, (SELECT MIN(ids.id) FROM ids WHERE ids.name = best.name)) AS id
        FROM merged LEFT JOIN best ON best.abbr = merged.abbr AND id_fbref IS NULL),
    given AS (SELECT DISTINCT full_name, upper(substr(md5(full_name), 1, 8)) AS id FROM resolved
              WHERE substr(md5(full_name), 1, 1) < '8')
    SELECT 'final' AS list, r.id_fpl, r.full_name, CASE WHEN r.id IS NULL THEN COALESCE('Given ' || given.id, r.name) ELSE r.name END AS name,
           COALESCE(r.id, given.id) AS id
    FROM resolved r LEFT JOIN given ON given.full_name = r.full_name
    UNION ALL
    SELECT 'missing', NULL, r.full_name, NULL, NULL
    FROM resolved r LEFT JOIN given ON given.full_name = r.full_name WHERE COALESCE(r.id, given.id) IS NULL
    """
)
def identity_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cascade with links given by hand for half of all people, and the names still missing."""
    people, ids, previous = _cascade_inputs(spark, sf_dir)
    whole = F.concat_ws(" ", "first_name", "second_name")
    digest = F.md5(whole.cast("binary"))
    given = people.where(F.substring(digest, 1, 1) < "8").select(whole.alias("full_name_full"), F.upper(F.substring(digest, 1, 8)).alias("id"))
    links = given.distinct().select(
        "full_name_full", F.concat(F.lit("https://stats.example.org/en/players/"), "id", F.lit("/Given-"), "id").alias("link")
    )
    found = match_people(people, ids, previous, links, threshold=80)
    final = found.final.select(
        F.lit("final").alias("list"), "id_fpl", F.concat_ws(" ", "first_name_fpl", "second_name_fpl").alias("full_name"),
        F.col("name_fbref").alias("name"), F.col("id_fbref").alias("id"),
    )
    none = F.lit(None)
    missing = found.missing.select(
        F.lit("missing").alias("list"), none.cast("long").alias("id_fpl"), F.col("full_name_full").alias("full_name"),
        none.cast("string").alias("name"), none.cast("string").alias("id"),
    )
    return final.unionByName(missing)


@query(
    f"""
    SELECT a.name AS left_name, b.name AS right_name, {SCORE_SQL.format("a.name", "b.name")} AS score
    FROM ({PARTS_SQL}) a JOIN ({PARTS_SQL}) b ON b.id = a.id + 1
    """
)
def neighbour_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _parts(spark, sf_dir)
    left = parts.select(F.col("name").alias("left_name"), (F.col("id") + 1).alias("next"))
    right = parts.select(F.col("name").alias("right_name"), F.col("id").alias("next"))
    score = similarity(F.col("left_name"), F.col("right_name"))
    return left.join(right, "next").select("left_name", "right_name", score.alias("score"))
