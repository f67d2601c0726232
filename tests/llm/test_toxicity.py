"""Toxicity: passages against a loop, held-out accuracy, misspelt words, and small or odd inputs."""

import random

import numpy as np
import pytest
from edge_rows import docs, no_docs, texts

from touchline.llm.queries import QUERIES
from touchline.llm.toxicity import PASSAGE, _distinct, _words, best_passages, fit, score_toxicity, train_toxicity


def made_up(count, seed, insults=("dreadfulfool", "wretchedswine")):
    rng = random.Random(seed)
    plain = ["".join(rng.choice("aeiourstln") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    rows = []
    for i in range(count):
        words = rng.choices(plain, k=rng.randint(5, 200))
        toxic = i % 5 == 0
        for _ in range(1 + len(words) // 50 if toxic else 0):
            words.insert(rng.randint(0, len(words)), rng.choice(insults))
        rows.append((" ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def model():
    rows = made_up(500, 1)
    return fit([t for t, _ in rows], np.array([y for _, y in rows]), np.ones(len(rows)))


def test_unseen_documents_and_misspellings(model):
    rows = made_up(600, 1)[500:]
    score = model.score([t for t, _ in rows])
    assert ((score >= 0.5) == [bool(y) for _, y in rows]).mean() > 0.95
    base = " ".join(rows[1][0].split()[:20])
    plain, right, wrong = model.score([base, base + " dreadfulfool", base + " dreadfullfool"])
    assert plain < 0.5 < right and wrong > 5 * plain


def test_best_passages_agree_with_a_loop():
    rng = np.random.default_rng(2)
    samples = ["a b c", "", " ".join(f"w{i}" for i in range(30)), "same same same other", "x" * 50]
    words = _words(samples)
    numbers = rng.normal(size=1 << 17)
    counts = np.bincount(words.owners)
    best, place, length = best_passages(np.bincount(words.owners, numbers[words.buckets]) / counts, words.first, PASSAGE)
    for i in range(len(samples)):
        own = []
        for w in range(words.first[i], words.first[i + 1]):
            grams = words.buckets[words.owners == w]
            own.append(numbers[grams].mean())
        size = min(len(own), PASSAGE)
        means = [np.mean(own[k : k + size]) for k in range(len(own) - size + 1)] if own else [0.0]
        assert best[i] == pytest.approx(max(means)) and length[i] == size
        assert not own or place[i] - words.first[i] == int(np.argmax(means))
    assert np.diff(words.first).tolist() == [3, 0, 30, 2, 1]


def test_distinct_words_hold_the_same_grams():
    samples = ["a b c", " ", "same same same Other", "other a\xa0b zz"]
    whole = _words(samples)
    words, first, buckets, grams = _distinct(samples)
    assert np.array_equal(first, whole.first)
    for i, word in enumerate(words):
        assert np.array_equal(np.sort(buckets[grams[word] : grams[word + 1]]), np.sort(whole.buckets[whole.owners == i]))


def test_grams_do_not_depend_on_other_texts():
    alone = [np.sort(_words([t]).buckets) for t in ("ab cd", "efg", "ab")]
    together = _words(["ab cd", "efg", "ab"])
    ends = np.searchsorted(together.first, together.owners, "right") - 1
    for i in range(3):
        assert np.array_equal(np.sort(together.buckets[ends == i]), alone[i])


def test_edge_rows(spark, model):
    scored = score_toxicity(docs(spark), model, score_col="toxicity")
    assert scored.columns == [*docs(spark).columns, "toxicity"]
    rows = scored.collect()
    assert len(rows) == 10 and all(0 <= r.toxicity <= 1 for r in rows)
    empty = {r.toxicity for r in rows if r.doc_id in (3, 4, 5)}
    assert len(empty) == 1
    assert score_toxicity(no_docs(spark), model).collect() == []


def test_without_labels_of_both_classes(spark):
    frame = texts(spark, ["a b c", "d e f", "g h i"])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert train_toxicity(frame, none).score(["x", ""]).tolist() == pytest.approx([0, 0])
    clean = spark.createDataFrame([(1, 1, 0), (2, None, None), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert train_toxicity(frame, clean).score(["x", ""]).tolist() == pytest.approx([0, 0])
    assert train_toxicity(no_docs(spark), clean).score(["x"]).tolist() == pytest.approx([0])


def test_held_out_labels_of_the_test_tables(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = QUERIES["op4_toxicity"](spark, folder).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 50
    right = sum(r.predicted == r.toxic for r in held) / len(held)
    assert right > 0.9 and sum(r.predicted for r in held if not r.toxic) <= 2
