"""Joins, sets, ranks, metrics and matching against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from touchline.operators import aggregates as a
from touchline.operators import joins as j
from touchline.operators import matching as m
from touchline.operators import sets
from touchline.operators.quality import check, overlapping
from touchline.operators.ranking import capped_top_k, keep_first
from touchline.operators.windows import rolling
from touchline.plans.identity import match_people


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_either_side_equals_the_or_join(spark):
    rng = random.Random(3)
    matches = [(i, rng.randrange(5), rng.randrange(5)) for i in range(80)]
    sides = j.either_side(spark.createDataFrame(matches, "id int, home int, away int"), "home", "away", "team")
    got = sorted((r.id, r.team, r.opponent_team) for r in sides.collect())
    want = sorted((i, t, b if t == x else x) for i, x, b in matches for t in range(5) if t in (x, b))
    assert got == want


def test_valid_at_bounds_and_open_end(spark):
    facts = spark.sql(
        "SELECT * FROM VALUES (1, timestamp'2024-01-01'), (1, timestamp'2024-02-01'), (1, timestamp'2030-01-01'), (2, timestamp'2024-01-01') t(k, at)"
    )
    spans = spark.sql(
        "SELECT * FROM VALUES (1, 'a', timestamp'2024-01-01', timestamp'2024-02-01'), (1, 'b', timestamp'2024-02-01', cast(null as timestamp)) t(k, name, start_date, end_date)"
    )
    got = sorted((r.at.strftime("%Y-%m"), r.name) for r in j.valid_at(facts, spans, "k", "at").select("at", "name").collect())
    assert got == [("2024-01", "a"), ("2024-02", "a"), ("2024-02", "b"), ("2030-01", "b")]


def test_inclusive_frame_has_one_row_more(spark):
    df = spark.createDataFrame([(1, i, 1) for i in range(6)], "k int, at int, x int")
    exclusive = rolling(df, ["x"], ["k"], ["at"], 3).orderBy("at").collect()
    inclusive = rolling(df, ["x"], ["k"], ["at"], 3, True).orderBy("at").collect()
    assert [r.rolling_x for r in exclusive] == [None, 1, 2, 3, 3, 3]
    assert [r.rolling_x for r in inclusive] == [1, 2, 3, 4, 4, 4]
    before = rolling(df, {"x": "ub"}, ["k"], ["at"]).withColumn("sum", F.coalesce("rolling_ub", F.lit(0)) + F.col("x"))
    now = rolling(df, {"x": "ub"}, ["k"], ["at"], None, True)
    assert [r.sum for r in before.orderBy("at").collect()] == [r.rolling_ub for r in now.orderBy("at").collect()]


def greedy(rows, caps, k):
    taken, counts = [], dict.fromkeys(caps, 0)
    for row in rows:
        if row[1] in caps and len(taken) < k and counts[row[1]] < caps[row[1]]:
            taken.append(row[0])
            counts[row[1]] += 1
    return taken


def test_capped_top_k_is_greedy(spark):
    rng = random.Random(11)
    rows = [(i, rng.choice(["DEF", "MID", "FWD", "GK"]), rng.randrange(40), rng.randrange(6)) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, position string, points int, week int")
    got = capped_top_k(df, ["week"], "position", a.SQUAD_CAPS, 10, [F.desc("points"), F.asc("id")])
    for week in range(6):
        mine = [r.id for r in got.where(F.col("week") == week).orderBy("selection_rank").collect()]
        assert mine == greedy(sorted([r for r in rows if r[3] == week], key=lambda r: (-r[2], r[0])), a.SQUAD_CAPS, 10)


def test_keep_first_and_sets(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "k string, v int")
    assert rows_of(keep_first(df, ["k"], [F.asc("v")])) == [("a", 1), ("b", 3)]
    other = spark.createDataFrame([("a", 9.5)], "k string, w double")
    assert rows_of(sets.outer_union(df, other).where("k = 'a' AND v IS NULL")) == [("a", None, 9.5)]
    assert sets.missing_columns(df, other) == ["v"]
    assert rows_of(sets.missing_rows(df.select("k"), other.select("k"))) == [("b",)]
    assert rows_of(sets.common_rows(df.select("k"), other.select("k"))) == [("a",)]


def test_columns_of_distinct_rows(spark):
    rows = [(1, 1, 5, "x"), (1, 2, 5, "x"), (1, 2, 5, "x"), (1, 2, 5, "y"), (None, 3, 6, None), (None, 3, 6, None), (2, None, 7, "z")]
    df = spark.createDataFrame(rows, "a int, b int, c int, d string")
    for part in (df, df.where("a = 1"), df.where("b = 1"), df.where("a = 9")):
        expected = rows_of(part.distinct().select("a", "b", "c"))
        assert rows_of(sets.columns_of_distinct(part, ["a", "b"], ["a", "b", "c"])) == expected


def test_tenures_stay_open_at_the_last_date(spark):
    df = spark.createDataFrame([("p", "x", 1), ("p", "x", 3), ("p", "y", 4), ("q", "x", 9)], "p string, t string, d int")
    got = rows_of(a.tenures(df, ["p", "t"], "d", df.agg(F.max("d")).scalar()))
    assert got == [("p", "x", 1, 3), ("p", "y", 4, 4), ("q", "x", 9, None)]


def test_combined_error_balances_and_survives_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0, 2.0, 2.5), (0.0, 1.0, 1.0, 1.0)], "g double, pg double, a double, pa double")
    row = a.combined_error(df, [("g", "pg"), ("a", "pa")]).first()
    r1, r2, m1, m2 = 1.0, math.sqrt(0.125), 1.0, 0.25
    want = 0.5 * (0.7 * r1 + 0.3 * r2) / (r1 + r2) + 0.5 * (0.7 * m1 + 0.3 * m2) / (m1 + m2)
    assert row.combined_metric == pytest.approx(want)
    assert (row.output1_rmse, row.output2_mae) == (pytest.approx(r1), pytest.approx(m2))
    perfect = a.combined_error(df.withColumn("pg", F.col("g")).withColumn("pa", F.col("a")), [("g", "pg"), ("a", "pa")])
    assert perfect.first().combined_metric is None


def test_rank_metrics(spark):
    rows = [("a", "x", 1, 1), ("b", "x", 2, 3), ("c", "x", 3, 2), ("d", "y", 1, 1), ("d", "y", 2, 2)]
    df = spark.createDataFrame(rows, "player_name string, position string, predicted_rank int, actual_rank int")
    metrics = a.ranking_metrics(df, k=2).first()
    assert (metrics.hit_rate, metrics.precision_at_k, metrics.recall_at_k) == (0.75, 0.75, 0.75)
    by = {r.position: r.accuracy for r in a.topk_overlap(df, "player_name", ["position"], k=2).collect()}
    assert by == {"x": 0.5, "y": 1.0}
    assert a.topk_overlap(df, "player_name", ["position"], overall=True, k=2).first().accuracy == pytest.approx(2 / 3)
    assert a.weighted_accuracy(df, k=2).first()[0] == pytest.approx((2 + 2 + 1) / 6)


def test_quantiles_interpolate(spark):
    import numpy as np

    rng = random.Random(4)
    xs = [rng.randrange(30) / 4 for _ in range(997)]
    df = spark.createDataFrame([(x, None if i % 3 else x * 2) for i, x in enumerate(xs)], "x double, y double")
    shares = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r.column, r.share): r.quantile for r in a.quantiles(df, ["x", "y"], shares).collect()}
    ys = [x * 2 for i, x in enumerate(xs) if not i % 3]
    for share in shares:
        assert got["x", share] == pytest.approx(np.quantile(xs, share))
        assert got["y", share] == pytest.approx(np.quantile(ys, share))


def test_summary_and_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, 4.0), (3, 8.0), (4, None)], "a int, b double")
    row = {r.column: r for r in a.numeric_summary(df).collect()}
    assert (row["a"]["count"], row["a"]["mean"], row["a"]["50%"], row["b"]["25%"]) == (4, 2.5, 2.5, 5.0)
    assert a.columns_with_nulls(df, 0.4) == ["b"] and a.columns_with_nulls(df, 0.5) == []


def test_value_scores(spark):
    df = spark.createDataFrame([(10.0, 5.0, 180.0), (10.0, None, 0.0), (10.0, 0.0, 90.0)], "pts double, price double, mins double")
    got = rows_of(a.value_scores(df, "price", "mins", {"ppv": "pts"}, {"p90": "pts"}).select("ppv", "p90"))
    assert got == sorted([(2.0, 5.0), (None, 0.0), (None, 10.0)], key=repr)


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b")], "id int, name string")
    got = {(r.check, r.column): r.failures for r in check(df, ["id"], ["id", "name"], ["id", "gone"], True).collect()}
    assert got == {
        ("required", "id"): 0, ("required", "gone"): 1, ("not_null", "id"): 1, ("not_null", "name"): 1,
        ("not_empty", "*"): 0, ("unique", "id"): 1,
    }
    assert check(df.limit(0), not_empty=True).first().failures == 1
    spans = spark.sql("SELECT * FROM VALUES (1, timestamp'2024-01-01', cast(null as timestamp)), (1, timestamp'2024-03-01', timestamp'2024-04-01') t(k, start_date, end_date)")
    assert overlapping(spans, "k").count() == 1


def distance(a_text, b_text):
    row = list(range(len(b_text) + 1))
    for i, x in enumerate(a_text, 1):
        new = [i]
        for k, y in enumerate(b_text, 1):
            new.append(min(row[k] + 1, new[-1] + 1, row[k - 1] + (x != y)))
        row = new
    return row[-1]


def score(x, y):
    return math.floor(100 * (1 - distance(x, y) / max(len(x), len(y))) + 0.5)


def changed(text, rng):
    letters = list(text)
    for _ in range(rng.randint(0, 5)):
        at = rng.randrange(len(letters) + 1)
        kind = rng.random()
        if kind < 0.3 and at < len(letters):
            letters[at] = rng.choice("abc ")
        elif kind < 0.6 and at < len(letters):
            del letters[at]
        else:
            letters.insert(at, rng.choice("abc "))
    return "".join(letters)


@pytest.mark.parametrize("threshold", [72, 80, 95])
def test_no_matching_pair_is_missed(spark, threshold):
    """Short texts share a form with letters left out, long ones a segment; both ways have to be exact."""
    rng = random.Random(threshold)
    base = ["".join(rng.choice("abc ") for _ in range(rng.randint(1, 60))) for _ in range(80)]
    left = {t for t in base + [changed(t, rng) for t in base] if t}
    right = {t for t in [changed(t, rng) for t in base for _ in range(2)] if t}
    pairs = m.candidate_pairs(
        spark.createDataFrame([(t,) for t in left], "t string"), spark.createDataFrame([(t,) for t in right], "t string"), "t", threshold
    )
    got = {tuple(r) for r in pairs.collect()}
    assert {(x, y) for x in left for y in right if score(x, y) >= threshold} <= got


def test_fuzzy_best_folds_and_sorts_tokens(spark):
    people = spark.createDataFrame([("Müller Thomas",), ("Nobody Here",), ("Alexander-Arnoldd Trent",), (None,)], "who string")
    known = spark.createDataFrame([("Thomas Muller",), ("Trent Alexander-Arnold",), ("Tomas Miller",)], "name string")
    got = {r.who: (r.fuzzy_match, r.score) for r in m.fuzzy_best(people, known, "who", "name").collect()}
    assert got == {"Müller Thomas": ("Thomas Muller", 100), "Alexander-Arnoldd Trent": ("Trent Alexander-Arnold", 96)}


def test_match_people(spark):
    people = spark.createDataFrame(
        [("Ann", "Lee", 1), ("José", "Pérez", 2), ("Old", "Friend", 3), ("Lost", "Soul", 4), ("By", "Hand", 5)],
        "first_name string, second_name string, id int",
    )
    ids = spark.createDataFrame([("Ann Lee", "x1"), ("Jose Perez", "x2"), ("Peter Soul", "x4"), ("Ann Lee", "x9")], "name string, id string")
    previous = spark.createDataFrame([("Old", "Friend", "x3")], "first_name_fpl string, second_name_fpl string, id_fbref string")
    overrides = spark.createDataFrame(
        [("By Hand", "https://x.example/en/players/x5/By-Hand"), ("Ann Lee", "https://x.example/en/players/zz/No-One")],
        "full_name_full string, link string",
    )
    found = match_people(people, ids, previous, overrides)
    final = {r.id_fpl: (r.name_fbref, r.id_fbref) for r in found.final.collect()}
    assert final == {1: ("Ann Lee", "x1"), 2: ("Jose Perez", "x2"), 3: (None, "x3"), 4: (None, None), 5: ("By Hand", "x5")}
    assert [r[0] for r in found.missing.collect()] == ["Lost Soul"]
    queue = {(r.second_name, r.candidate) for r in found.by_last_name.collect()}
    assert queue == {("Soul", "Peter Soul")}
    assert rows_of(found.by_first_name) == []


def test_latest_attribute_keeps_all_rows(spark):
    history = spark.createDataFrame([("a", 1, 5), ("a", 2, 6), ("b", 1, 7)], "k string, gw int, v int")
    got = rows_of(j.latest_attribute(history.select("k").distinct(), history, "k", "gw", ["v"]))
    assert got == [("a", 6), ("b", None)]
