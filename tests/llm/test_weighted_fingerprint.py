"""Weighted fingerprints against the exact generalised Jaccard similarity, and neighbours against a sorted list."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
from edge_rows import docs, no_docs

from touchline.llm.weighted_fingerprint import edited, fingerprint_pairs, likeness, neighbours, signatures, written_out


def jaccard(a, b):
    a, b = (Counter(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in (a, b))
    return sum((a & b).values()) / sum((a | b).values())


def test_equal_draws_are_as_frequent_as_the_similarity():
    rng = random.Random(4)
    pairs = []
    for n in range(600):
        # Words of their own, as equal words draw the same in every pair.
        words = [f"w{n}-{i}" for i in range(60)]
        a = rng.choices(words, k=rng.randint(5, 200))
        b = a[: rng.randint(0, len(a))] + rng.choices(words, k=rng.randint(1, 60))
        pairs.append((" ".join(a), " ".join(b)))
    found = likeness(signatures([a for a, _ in pairs]), signatures([b for _, b in pairs]))
    exact = np.array([jaccard(a, b) for a, b in pairs])
    # 64 draws have a standard error of at most 1/16.
    assert abs((found - exact).mean()) < 0.008 and np.abs(found - exact).max() < 0.3
    assert np.sqrt(((found - exact) ** 2).mean()) < 0.07


def test_a_fingerprint_depends_on_the_text_alone():
    texts = ["a b b c", "", "x y", "a b b c", "c b a b", "word " * 5000]
    together = signatures(texts)
    assert (together == np.concatenate([signatures([t]) for t in texts])).all()
    assert (together[0] == together[3]).all() and (together[0] == together[4]).all() and not together[1].any()
    assert len(set(written_out(together))) == 4 and {len(x) for x in written_out(together)} == {256}


def expected(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    result = []
    for (i, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        changed = edited(text or "", following or "")
        codes = signatures([text or "", changed, following or ""])
        result.append(
            (
                i,
                len(text or ""),
                hashlib.sha256(changed.encode()).hexdigest(),
                *written_out(codes[:2]),
                likeness(codes[:1], codes[1:2])[0],
                likeness(codes[:1], codes[2:])[0],
            )
        )
    return result


def test_neighbours_over_many_partitions(spark):
    rng = random.Random(2)
    ids = rng.sample(range(-1000, 100_000), 150)
    rows = [(i, " ".join(rng.choice("abcdé\U0001f600") * rng.randint(1, 3) for _ in range(rng.randint(0, 30)))) for i in ids]
    rows += [(None, "first of all")]
    for parts in (1, 7):
        frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        found = sorted((tuple(r) for r in fingerprint_pairs(frame).collect()), key=lambda r: (r[0] is not None, r[0] or 0))
        assert found == expected(rows)


def test_edge_rows(spark):
    found = {r.doc_id: r for r in fingerprint_pairs(docs(spark)).collect()}
    assert len(found) == 9 and fingerprint_pairs(docs(spark)).count() == 10
    assert found[3].fingerprint == found[4].fingerprint == found[5].fingerprint == "0" * 256
    assert (found[3].near_next, found[4].near_next, found[5].near_next) == (1.0, 1.0, 0.0)
    assert found[1].fingerprint == found[2].fingerprint and found[1].near_next == 1.0
    # The row without an id comes first and follows the last one.
    assert found[8].edited_sha256 == hashlib.sha256(edited(docs(spark).where("doc_id = 8").first().text, "a row without an id").encode()).hexdigest()
    assert fingerprint_pairs(no_docs(spark)).collect() == []


def test_a_single_row_is_its_own_neighbour(spark):
    row = fingerprint_pairs(spark.createDataFrame([(5, "abcdef gh")], "doc_id long, text string")).collect()
    assert len(row) == 1 and row[0].near_next == 1.0
    assert row[0].edited_sha256 == hashlib.sha256(b"abcdeabcd").hexdigest()


def test_rows_of_one_id_are_dealt_by_their_texts(spark):
    rng = random.Random(6)
    word = lambda: rng.choice(["ab", "cd", "ef", "gh"]) * rng.randint(1, 3)
    rows = [(i, f"{n} " + " ".join(word() for _ in range(6))) for n, i in enumerate([None] * 60 + [7] * 60 + list(range(-20, 40)))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    ordered = frame.orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).collect()
    following = [r.text for r in ordered[1:] + ordered[:1]]
    wanted = sorted((r.doc_id is None, r.doc_id or 0, hashlib.sha256(edited(r.text, f).encode()).hexdigest()) for r, f in zip(ordered, following))
    found = sorted((r.doc_id is None, r.doc_id or 0, r.edited_sha256) for r in fingerprint_pairs(frame).collect())
    assert found == wanted
    dealt = neighbours(frame, "doc_id", "text").where("not copied").groupBy("doc_id").agg(F.countDistinct("bucket").alias("n"))
    buckets = {r.doc_id: r.n for r in dealt.collect()}
    assert buckets[None] >= 3 and buckets[7] >= 3 and buckets[8] == 1
