"""Ranked search against a plain scan, exact sums, and odd rows."""

import math
import random
import re

import numpy as np
import pytest
from edge_rows import LONG, docs, no_docs

from touchline.llm import lexical_search as module
from touchline.llm.lexical_search import EXACT, IMPACT_BOUND, search, slices

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def plain_search(rows, items, k):
    listed = [(i, plain_terms(t)) for i, t in rows]
    n_docs = sum(bool(t) for _, t in listed)
    n_terms = sum(len(t) for _, t in listed)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(plain_terms(text))
    df = {}
    for _, terms in listed:
        for t in set(terms):
            df[t] = df.get(t, 0) + 1
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * c + 1))) for t, c in df.items()}
    found = []
    for item, terms in wanted.items():
        scored = []
        for doc, own in listed:
            m = 50 + 50 * len(own) * n_docs // max(1, n_terms)
            score = 0
            for t in terms:
                tf = own.count(t)
                score += weight.get(t, 0) * (10**9 * tf // (1000 * tf + 20 * m))
            if score > 0:
                scored.append((-score, doc is None, doc))
        for rank, (score, _, doc) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1):
            found.append((item, rank, doc, -score))
    return found


def rows_of(df):
    return sorted([tuple(r) for r in df.collect()], key=lambda r: (r[0] is None, r[0] or 0, r[1]))


@pytest.mark.parametrize("small", [False, True])
def test_agrees_with_a_plain_scan(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(module, "TILE_DOCS", 7)
        monkeypatch.setattr(module, "TILE_ITEMS", 2)
        monkeypatch.setattr(module, "TILE_TERMS", 3)
        monkeypatch.setattr(module, "BLOCK_TERMS", 12)
    rng = random.Random(3)
    word = lambda: rng.choice(["Alpha", "beta", "Über", "x1", "naïve", "日本", "gamma", "delta", "e", "ZETA"])
    made = [" ".join(word() for _ in range(rng.randrange(0, 25))) for _ in range(60)]
    # Many equal texts: ties at the last place.
    made += ["alpha beta gamma"] * 40
    items = [(i, " ".join(word() for _ in range(rng.randrange(1, 6)))) for i in range(7)]
    items += [(3, "another text of item three"), (90, None), (91, "!!"), (None, "beta")]
    spark_items = spark.createDataFrame(items, "item_id long, text string")
    rows = list(enumerate(made))
    rng.shuffle(rows)
    for k in (1, 5, 50):
        found = rows_of(search(spark.createDataFrame(rows, "doc_id long, text string"), spark_items, k))
        expected = sorted(plain_search(rows, items, k), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        assert found == expected and found


def test_odd_rows(spark):
    items = [(1, "the lazy DOG"), (2, "word1 word976 id"), (3, "\U0001f600 schöne")]
    rows = [(r.doc_id, r.text) for r in docs(spark).collect()]
    found = rows_of(search(docs(spark), spark.createDataFrame(items, "item_id long, text string"), 4))
    assert found == sorted(plain_search(rows, items, 4), key=lambda r: (r[0], r[1]))
    assert {r[2] for r in found if r[0] == 2} >= {6, None} and LONG
    assert search(no_docs(spark), spark.createDataFrame(items, "item_id long, text string")).collect() == []
    empty = search(docs(spark), spark.createDataFrame([], "item_id long, text string"))
    assert empty.collect() == [] and empty.columns == ["item_id", "rank", "doc_id", "score"]


def test_partial_sums_stay_exact():
    weights = np.full((3, 40), EXACT // IMPACT_BOUND // 8, np.int64)
    cuts = slices(weights, 1000)
    assert [c.start for c in cuts[1:]] == [c.stop for c in cuts[:-1]] and cuts[-1].stop == 40
    assert len(cuts) > 3 and all(weights[:, c].sum(axis=1).max() * IMPACT_BOUND < EXACT for c in cuts)
    assert [c.stop for c in slices(np.ones((2, 10), np.int64), 4)] == [4, 8, 10]
