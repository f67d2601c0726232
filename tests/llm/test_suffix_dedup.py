"""Repeated byte strings against a plain count of all windows, with small windows, hot triggers and odd rows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from edge_rows import docs, no_docs, texts

from touchline.llm import hot_keys
from touchline.llm.suffix_dedup import equal_windows, remove_repeats, suffix_order


def plain(values, window):
    raw = [(v or "").encode() for v in values]
    count = Counter(t[i : i + window] for t in raw for i in range(len(t) - window + 1))
    found = []
    for t in raw:
        gone = [False] * len(t)
        for i in range(len(t) - window + 1):
            if count[t[i : i + window]] > 1:
                gone[i : i + window] = [True] * window
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        found.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest(), kept))
    return found


def found_in(df):
    return [tuple(r)[1:5] + (bytes(r.kept),) for r in sorted(df.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))]


def some_texts(rng, alphabet, many):
    passages = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(18, 70))) for _ in range(6)]
    made = []
    for _ in range(many):
        text = ""
        for _ in range(rng.randrange(0, 5)):
            text += "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 30)))
            passage = rng.choice(passages)
            cut = rng.randrange(len(passage))
            text += rng.choice([passage, passage[cut:], passage[:cut], ""])
        made.append(text)
    return made


@pytest.mark.parametrize(
    "window,gram,limit,alphabet",
    [(20, 5, 20_000, "abcdefgé"), (20, 5, 1, "abcdefgé"), (24, 20, 3, "ab"), (17, 4, 20_000, "a"), (16, 16, 2, "abc")],
)
def test_agrees_with_all_windows(spark, monkeypatch, window, gram, limit, alphabet):
    monkeypatch.setattr(hot_keys, "HOT_ROWS", 4)
    made = some_texts(random.Random(window + limit), alphabet, 90)
    made += made[:6] + [made[3] + made[4], "a" * 70, None, ""]
    found = found_in(remove_repeats(texts(spark, made), window, gram, limit))
    expected = plain(made, window)
    assert found == expected and sum(r[1] for r in expected) > 100


def test_long_texts_and_a_line_with_ever_different_neighbours(spark):
    rng = random.Random(11)
    line = "".join(rng.choice("abcdefgh ") for _ in range(230))
    made = ["".join(rng.choice("abcdefgh ") for _ in range(90)) + line + "".join(rng.choice("abcdefgh ") for _ in range(90)) for _ in range(80)]
    long = " ".join(f"word{i % 977}" for i in range(9000))
    made += [long, long[100:900], "x" * 1000, "y" * 199, "z" * 200]
    for limit in (20_000, 10):
        assert found_in(remove_repeats(texts(spark, made), group_limit=limit)) == plain(made, 200)


def test_odd_rows(spark):
    rows = docs(spark).collect()
    order = sorted(range(len(rows)), key=lambda i: (rows[i].doc_id is None, rows[i].doc_id or 0))
    expected = plain([r.text for r in rows], 30)
    assert found_in(remove_repeats(docs(spark), 30, 8)) == [expected[i] for i in order]
    assert remove_repeats(no_docs(spark)).collect() == []
    twice = spark.createDataFrame([(None, "q" * 10 + "r" * 20), (None, "q" * 10 + "r" * 20), (0, "q" * 9)], "doc_id long, text string")
    assert [(r.doc_id, r.n_removed) for r in remove_repeats(twice, 25, 8).collect() if r.n_removed] == [(None, 30)] * 2


def test_orders_of_a_group():
    rng = np.random.default_rng(2)
    matrix = rng.integers(0, 3, (200, 16)).astype(np.uint8)
    group = np.sort(rng.integers(0, 4, 200))
    order, common = suffix_order(matrix, group)
    strings = [(g, bytes(m)) for g, m in zip(group, matrix)]
    assert [strings[i] for i in order] == sorted(strings)
    for i in range(1, 200):
        (g, a), (h, b) = strings[order[i - 1]], strings[order[i]]
        same = next((k for k in range(16) if a[k] != b[k]), 16)
        assert common[i] == (same if g == h else -1)
    lo, hi = np.zeros(200, np.int64), np.full(200, 8)
    heads, tails = matrix, np.roll(matrix, 3, axis=0)
    found = equal_windows(group, heads, tails, lo, hi, 11)
    for before in range(9):
        keys = [(g, bytes(h[:before]), bytes(t[: 11 - before])) for g, h, t in zip(group, heads, tails)]
        count = Counter(keys)
        assert [count[k] > 1 for k in keys] == found[:, before].tolist()
