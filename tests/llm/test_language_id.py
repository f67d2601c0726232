"""Language identification: code lengths against a plain context tree, and held-out accuracy."""

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from edge_rows import docs, no_docs

from touchline.llm.arrow_text import text_bytes
from touchline.llm.language_id import ORDER, ContextTrees, Lookup, Scorer, predict_language, train_language_id
from touchline.llm.queries import QUERIES


def plain_trees(rows):
    trees = defaultdict(lambda: defaultdict(Counter))
    for lang, text in rows:
        data = text.encode()
        for i in range(len(data)):
            for k in range(min(i, ORDER) + 1):
                trees[lang][data[i - k : i]][data[i]] += 1
    return trees


def bits(tree, text):
    data, total = text.encode(), 0.0
    for i in range(len(data)):
        for k in range(min(ORDER, i), -1, -1):
            after = tree.get(data[i - k : i])
            if after:
                n, d = sum(after.values()), len(after)
                if after[data[i]]:
                    total -= math.log2(after[data[i]] / (n + d))
                    break
                total -= math.log2(d / (n + d))
        else:
            total += 8
    return total


def test_code_lengths_agree_with_plain_trees(spark):
    rows = [("de", "die Straße und der Bär und die Straße"), ("en", "the street and the bear"), ("en", "the the then")]
    frame = spark.createDataFrame([(3 * i, text, lang) for i, (lang, text) in enumerate(rows)], "doc_id long, text string, lang string")
    learnt = [i for i in (0, 3, 6) if __import__("zlib").crc32(str(i).encode()) % 3 != 1]
    trees = train_language_id(frame)
    plain = plain_trees([rows[i // 3] for i in learnt])
    samples = ["the bear", "die Bären", "", "a", "\U0001f600 unseen ÿÿ", "the street and the bear and so on"]
    data, offsets = text_bytes(pa.array(samples))
    found = Scorer(trees).lengths(data, offsets)
    for i, text in enumerate(samples):
        assert found[i].tolist() == pytest.approx([bits(plain[lang], text) for lang in trees.langs], abs=1e-3)


def test_lookup_finds_all_keys_and_no_other():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 40, 20_000).astype(np.uint64))
    lookup = Lookup(keys)
    assert (lookup.find(keys) == np.arange(len(keys))).all()
    others = np.setdiff1d(rng.integers(0, 1 << 40, 20_000).astype(np.uint64), keys)
    assert (lookup.find(others) == -1).all() and len(Lookup(keys[:0]).find(others)) == len(others)


def test_edge_rows(spark):
    trees = train_language_id(docs(spark))
    rows = {r.doc_id: r for r in predict_language(docs(spark), trees).collect()}
    assert len(rows) == 9 and predict_language(docs(spark), trees).count() == 10
    assert all((rows[i].lang_pred, rows[i].score) == ("und", 0.0) for i in (3, 4, 5, 7))
    assert {r.lang_pred for r in rows.values()} <= {"und", "de", "en"}
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert predict_language(no_docs(spark), trees).collect() == []


def test_many_languages_are_sampled_in_one_plan(spark):
    rows = [(i, f"text {i}", f"l{i % 60}") for i in range(3000)]
    frame = spark.createDataFrame(rows + rows[:500], "doc_id long, text string, lang string")
    trees = train_language_id(frame, order=1, sample=5)
    assert trees.langs == sorted({r[2] for r in rows})
    # The sample is counted through the word all texts begin with; repeated rows of a chosen id count again.
    chosen = {i: r[2] for i, r in enumerate(rows) if __import__("zlib").crc32(str(i).encode()) % 3 != 1}
    hashed = {r.id: r.h for r in spark.range(3000).selectExpr("id", "xxhash64(id) AS h").collect()}
    for lang in trees.langs[:3]:
        ids = sorted((i for i in chosen if chosen[i] == lang), key=lambda i: (hashed[i], i))[:5]
        plain = plain_trees([(lang, rows[i][1]) for i in ids for _ in range(1 + (i < 500))])
        data, offsets = text_bytes(pa.array(["text 7"]))
        found = Scorer(trees).lengths(data, offsets)[0][trees.langs.index(lang)]
        after = {k: v for k, v in plain[lang].items() if len(k) <= 1}
        assert found == pytest.approx(bits(after, "text 7"), abs=1e-3)


def test_nothing_learned(spark):
    trees = train_language_id(no_docs(spark))
    assert trees.langs == [] and isinstance(trees, ContextTrees)
    assert {r.lang_pred for r in predict_language(docs(spark), trees).collect()} == {"und"}


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    held = [r for r in QUERIES["op10_language_id"](spark, folder).collect() if r.held_out]
    assert len(held) > 200 and sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.98
