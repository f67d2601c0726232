"""Substring dedup against all windows in plain Python."""

import hashlib
import random
import re

import pytest
from edge_rows import docs, no_docs

from touchline.llm.substring_dedup import factor_table, remove_duplicates

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def expected(rows, window):
    """{(id, text): (words, removed, kept)} from the first document of every window."""
    earliest = {}
    split = [(i, t, WORDS.findall(t or "")) for i, t in rows]
    for i, _, words in split:
        for k in range(len(words) - window + 1):
            seq = tuple(words[k : k + window])
            if i is not None:
                earliest[seq] = min(earliest.get(seq, i), i)
    result = {}
    for i, t, words in split:
        gone = set()
        for k in range(len(words) - window + 1):
            if i is not None and earliest[tuple(words[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        result[i, t] = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    return result


def parse(rows, window):
    """Plain greedy parse of texts with ids of their own: {id: [(from, words, source, source from)]}."""
    split = {i: WORDS.findall(t or "") for i, t in rows}
    first = {}
    for i in sorted(split):
        for k in range(len(split[i]) - window + 1):
            first.setdefault(tuple(split[i][k : k + window]), (i, k))
    parsed = {}
    for i, words in split.items():
        k, factors = 0, []
        while k + window <= len(words):
            source, at = first[tuple(words[k : k + window])]
            size = 0
            while k + size + window <= len(words) and first[tuple(words[k + size : k + size + window])] == (source, at + size):
                size += 1
            if source < i:
                factors.append((k, size + window - 1, source, at))
            k += size
        parsed[i] = factors
    return parsed


def factors(spark, rows, window, gram):
    found = {i: [] for i, _ in rows}
    for r in factor_table(spark.createDataFrame(rows, "doc_id long, text string"), window, gram).collect():
        found[r.doc_id].append((r["from"], r.n_words, r.source_id, r.source_from))
    return {i: sorted(f) for i, f in found.items()}


def compare(spark, rows, window, gram):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = remove_duplicates(frame, window, gram).collect()
    want = expected(rows, window)
    assert len(found) == len(rows)
    assert sorted(
        ((r.doc_id is None, r.doc_id or 0), r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in found
    ) == sorted(((i is None, i or 0), *want[i, t]) for i, t in rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_documents_agree_with_all_windows(spark, seed):
    rng = random.Random(seed)
    passages = [[rng.choice("abcdefgh") for _ in range(rng.randint(5, 40))] for _ in range(6)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randint(0, 6)):
            part = rng.choice(passages) if rng.random() < 0.6 else [f"w{rng.randint(0, 500)}" for _ in range(rng.randint(1, 30))]
            a, b = sorted(rng.randint(0, len(part)) for _ in range(2)) if rng.random() < 0.4 else (0, len(part))
            words += part[a:b]
        # Ids neither dense nor in order of rows, two of them with several rows.
        rows.append((rng.choice([7, 13]) if i % 20 == 5 else 1000 - 11 * i, rng.choice([" ", "\n", "\t "]).join(words)))
    compare(spark, rows, 12, 3)


def test_one_word_over_and_over(spark):
    rows = [(1, "a " * 30), (2, "a " * 25), (3, "a " * 11), (4, "b " * 12 + "a " * 12), (5, None), (None, "a " * 30)]
    compare(spark, rows, 12, 3)


def test_factors_that_meet_at_a_border(spark):
    one, two = [f"x{i}" for i in range(30)], [f"y{i}" for i in range(30)]
    rows = [(1, " ".join(one)), (2, " ".join(two)), (3, " ".join(one + two)), (4, " ".join(one[:20] + two[10:]))]
    rows += [(5, " ".join(one[20:] + two[:10])), (6, " ".join(["z"] + one + two))]
    compare(spark, rows, 12, 3)


def test_a_copy_is_one_factor_across_blocks(spark):
    words = [f"w{k}" for k in range(300)]
    rows = [(1, " ".join(words)), (2, "new " + " ".join(words[40:]) + " end"), (3, " ".join(words[:30] + words[200:]))]
    found = factors(spark, rows, 12, 3)
    assert found == parse(rows, 12)
    assert found == {1: [], 2: [(1, 260, 1, 40)], 3: [(0, 30, 1, 0), (30, 100, 1, 200)]}


@pytest.mark.parametrize("seed", [4, 5])
def test_factors_agree_with_a_plain_parse(spark, seed):
    rng = random.Random(seed)
    passages = [[f"p{p}x{k}" for k in range(rng.randint(15, 60))] for p in range(8)]
    rows = []
    for i in range(50):
        words = []
        for _ in range(rng.randint(0, 5)):
            part = rng.choice(passages)
            a, b = sorted(rng.randint(0, len(part)) for _ in range(2)) if rng.random() < 0.5 else (0, len(part))
            words += part[a:b] + [f"u{rng.randint(0, 10**6)}"] * (rng.random() < 0.5)
        rows.append((7 * i + 1, " ".join(words)))
    assert_same_words(spark, rows)


def assert_same_words(spark, rows, window=12, gram=3):
    """Every factor repeats its source, factors cannot be joined, and they hold the plain parse's windows."""
    split = {i: WORDS.findall(t) for i, t in rows}
    found, plain = factors(spark, rows, window, gram), parse(rows, window)
    assert any(plain.values())
    for i, own in found.items():
        for at, size, source, there in own:
            assert source < i and size >= window
            assert split[i][at : at + size] == split[source][there : there + size]
        for (a, n, s, t), (b, _, s2, t2) in zip(own, own[1:]):
            assert b > a + n - window
            assert (b, s2, b - t2) != (a + n - window + 1, s, a - t)
        starts = [{k for at, size, *_ in f for k in range(at, at + size - window + 1)} for f in (own, plain[i])]
        assert starts[0] == starts[1]


def test_edge_rows(spark):
    rows = remove_duplicates(docs(spark)).collect()
    assert len(rows) == 10
    assert {r.doc_id: r.n_words for r in rows}[6] == 20_000
    assert all(r.n_removed == 0 for r in rows)
    assert {r.kept for r in rows if r.doc_id in (3, 4, 5)} == {""}
    assert remove_duplicates(no_docs(spark)).collect() == []
