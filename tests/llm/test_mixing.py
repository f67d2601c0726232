"""Raking against plain Python, marginals against targets, and odd inputs."""

import hashlib
from collections import defaultdict

import pytest
from edge_rows import docs, no_docs
from pyspark.sql import functions as F

from touchline.llm.mixing import (
    BOUNDED_ROUNDS,
    MISSING,
    ROUNDS,
    SHORTFALL,
    hash_share,
    mix,
    mix_documents,
    mixture_total,
    planned,
    rake,
    residuals,
    token_count,
)

MARGINS = ("a", "b", "c")


def plain_rake(cells, targets, rounds=ROUNDS):
    total = sum(cells.values())
    weight = {k: v / total for k, v in cells.items()}
    for _ in range(rounds):
        for i, name in enumerate(targets):
            sums = defaultdict(float)
            for k, w in weight.items():
                sums[k[i]] += w
            weight = {k: w * targets[name][k[i]] / sums[k[i]] for k, w in weight.items()}
    return weight


def plain_odds(cells, targets):
    """Probabilities of cells: the total by bisection, then rounds within bounds."""
    weight = plain_rake(cells, targets)
    low, high = 0.0, float(sum(cells.values()))
    lack = lambda t: sum(max(0.0, w - cells[k] / t) for k, w in weight.items())
    if lack(high) <= SHORTFALL:
        low = high
    for _ in range(200 if low < high else 0):
        middle = (low + high) / 2
        low, high = (middle, high) if lack(middle) <= SHORTFALL else (low, middle)
    weight = {k: min(w, cells[k] / low) for k, w in weight.items()}
    for _ in range(BOUNDED_ROUNDS):
        for i, name in enumerate(targets):
            sums = defaultdict(float)
            for k, w in weight.items():
                sums[k[i]] += w
            weight = {k: min(w * targets[name][k[i]] / sums[k[i]], cells[k] / low) for k, w in weight.items()}
    return {k: w * low / cells[k] for k, w in weight.items()}


def test_cells_meet_their_targets_and_agree_with_plain_python(spark):
    cells = {(x, y, z): 1 + (7 * i + 3 * j + 5 * k) % 23 for i, x in enumerate("pqrs") for j, y in enumerate("uv") for k, z in enumerate("mno")}
    del cells["p", "u", "m"]
    targets = {
        "a": {"p": 0.1, "q": 0.2, "r": 0.3, "s": 0.4},
        "b": {"u": 0.5, "v": 0.5},
        "c": {"m": 0.6, "n": 0.3, "o": 0.1},
    }
    frame = spark.createDataFrame([(*k, v) for k, v in cells.items()], "a string, b string, c string, tokens long")
    goals = {m: spark.createDataFrame(list(t.items()), f"{m} string, target double") for m, t in targets.items()}
    found = {(r.a, r.b, r.c): r.weight for r in rake(frame, goals).collect()}
    want = plain_rake(cells, targets)
    assert found == pytest.approx(want, rel=1e-9)
    for i, name in enumerate(MARGINS):
        for value, target in targets[name].items():
            assert sum(w for k, w in found.items() if k[i] == value) == pytest.approx(target, abs=1e-6)


def test_kept_tokens_follow_given_targets(spark):
    rows = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 8, "big").otherwise("small").alias("source"), F.lit("a b c").alias("text")
    )
    half = spark.createDataFrame([("big", 0.5), ("small", 0.5)], "source string, target double")
    mixed = mix(rows, {"source": F.col("source")}, token_count("text"), targets={"source": half})
    kept = {r.source: r["count"] for r in mixed.where("kept").groupBy("source").count().collect()}
    assert kept["small"] == 4000 and abs(kept["big"] - 4000) < 250
    again = mix(rows.repartition(5), {"source": F.col("source")}, token_count("text"), targets={"source": half})
    assert again.where("kept").select("doc_id").exceptAll(mixed.where("kept").select("doc_id")).isEmpty()


def test_odds_agree_with_plain_python(spark):
    cells = {(x, y): 1 + (7 * i * i + 3 * j) % 40 * 10 for i, x in enumerate("pqrstu") for j, y in enumerate("uvw")}
    cells["rare", "u"] = 1
    targets = {"a": {x: (1 + i) / 30 for i, x in enumerate("pqrstu")} | {"rare": 9 / 30}, "b": {"u": 0.4, "v": 0.4, "w": 0.2}}
    frame = spark.createDataFrame([(*k, v) for k, v in cells.items()], "a string, b string, tokens long")
    goals = {m: spark.createDataFrame(list(t.items()), f"{m} string, target double") for m, t in targets.items()}
    plan = planned(frame, goals)
    found = {(r.a, r.b): r.probability for r in plan.collect()}
    assert found == pytest.approx(plain_odds(cells, targets), rel=1e-6) and max(found.values()) <= 1
    shares = {(r.margin, r.value): r for r in residuals(plan, ["a", "b"]).collect()}
    kept = {k: found[k] * n for k, n in cells.items()}
    assert len(shares) == 10
    for i, name in enumerate("ab"):
        for value, target in targets[name].items():
            reached = sum(v for k, v in kept.items() if k[i] == value) / sum(kept.values())
            assert shares[name, value].target == target and shares[name, value].reached == pytest.approx(reached)
    assert shares["b", "w"].reached == pytest.approx(0.2, abs=0.03)


def test_a_rare_row_does_not_lower_what_is_kept_of_others(spark):
    rows = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.lit("a b c").alias("text"),
        F.concat(F.lit("s"), F.col("id") % 4).alias("source"), F.when(F.col("id") % 8 < 4, "en").otherwise("de").alias("lang"),
    )
    rare = spark.createDataFrame([(9999, "x", "new", None)], "doc_id long, text string, source string, lang string")
    shares = []
    for docs_ in (rows, rows.unionByName(rare)):
        kept = mix_documents(docs_).where("doc_id < 9999").agg(F.avg("probability"), F.avg(F.col("kept").cast("int"))).first()
        shares.append(kept)
    assert shares[0][0] == pytest.approx(1.0) and shares[0][1] == 1.0
    assert shares[1][0] > 0.99 and shares[1][1] > 0.985
    # Uneven sources: the share of the others moves by less than a hundredth.
    uneven = rows.withColumn("source", F.when(F.col("doc_id") % 10 < 6, "big").otherwise("small"))
    before, after = (mix_documents(d).where("doc_id < 9999").agg(F.avg("probability")).first()[0] for d in (uneven, uneven.unionByName(rare)))
    assert abs(after - before) < 0.01 * before and before < 1


def test_total_is_all_tokens_when_nothing_lacks(spark):
    cells = spark.createDataFrame([("p", 10), ("q", 30)], "a string, tokens long")
    even = rake(cells, {"a": spark.createDataFrame([("p", 0.25), ("q", 0.75)], "a string, target double")})
    assert mixture_total(even) == pytest.approx(40.0)
    half = rake(cells, {"a": spark.createDataFrame([("p", 0.5), ("q", 0.5)], "a string, target double")})
    assert mixture_total(half) == pytest.approx(10 / (0.5 - SHORTFALL))


def test_clashing_columns_raise(spark):
    for name in ("kept", "Mix_Source", "probability"):
        with pytest.raises(ValueError):
            mix_documents(docs(spark).withColumn(name, F.lit(1)))


def test_hash_of_the_id_alone(spark):
    rows = spark.createDataFrame([(1,), (None,), (2,)], "doc_id long").select("doc_id", hash_share("doc_id", "s").alias("u")).collect()
    for r in rows:
        key = "null" if r.doc_id is None else str(r.doc_id)
        assert r.u == int(hashlib.md5(f"s:{key}".encode()).hexdigest()[:8], 16) / 2**32


def test_edge_rows(spark):
    rows = mix_documents(docs(spark)).collect()
    assert len(rows) == 10
    by_id = defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append(r)
        assert 0 < r.probability <= 1
    assert by_id[3][0].mix_source == MISSING and by_id[3][0].mix_tokens == 1
    assert by_id[2][0].kept == by_id[2][1].kept and by_id[6][0].mix_tokens == 20_000
    assert {"text_hash", "score", "value"} <= set(rows[0].asDict())
    assert mix_documents(no_docs(spark)).collect() == []


def test_no_python_in_the_plan(spark):
    plan = mix_documents(docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan
