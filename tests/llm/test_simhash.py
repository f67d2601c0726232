"""SimHash near-dedup against all pairs, its trie join against brute force, and components."""

import re

import numpy as np
import xxhash
from edge_rows import docs, no_docs, texts
from hypothesis import given, settings
from hypothesis import strategies as st

from touchline.llm.components import components
from touchline.llm.simhash import BITS, near_duplicates, near_links, trie_groups

SF = "/root/testdata/sf0.001"


def fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, ids, budget=4):
    """Smallest id reachable for every place, by all pairs."""
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= budget or ids[i] == ids[j]:
                parent[root(i)] = root(j)
    members = {}
    for i in range(len(values)):
        members.setdefault(root(i), []).append(ids[i])
    return [min(members[root(i)]) for i in range(len(values))]


def test_documents_agree_with_all_pairs(spark):
    rows = near_duplicates(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    source = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = [r.doc_id for r in rows]
    values = [fingerprint(source[i]) for i in ids]
    assert [int(r.fingerprint, 16) for r in rows] == values
    assert [r.component_id for r in rows] == groups(values, ids)


def test_edge_rows(spark):
    rows = near_duplicates(docs(spark)).collect()
    found = {r.doc_id: r for r in rows}
    assert len(rows) == 10
    assert [found[i].fingerprint for i in (3, 4, 5)] == ["0" * 16] * 3
    assert [found[i].component_id for i in (1, 2, 3, 4, 5)] == [1, 1, 3, 3, 3]
    assert found[None].component_id is None and found[None].fingerprint != "0" * 16
    assert near_duplicates(no_docs(spark)).collect() == []


def test_rows_of_one_id_with_several_texts_are_one_document(spark):
    rows = spark.createDataFrame([(1, "a b c d e f"), (2, "v w x y z q"), (2, "a b c d e f")], "doc_id long, text string")
    assert {r.component_id for r in near_duplicates(rows).collect()} == {1}


def near_copies(count, seed):
    """Fingerprints of which many lie a few bits from a few centres."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**63, 6, dtype=np.uint64)
    values = centres[rng.integers(0, 6, count)]
    for _ in range(5):
        values = values ^ np.where(rng.random(count) < 0.7, np.uint64(1) << rng.integers(0, 64, count).astype(np.uint64), 0)
    return np.unique(values.astype(np.uint64))


def test_nodes_above_the_limit_are_split(spark):
    values = near_copies(400, 1)
    nodes = spark.createDataFrame(
        [(i, int(v) - (1 << 64 if int(v) >> 63 else 0)) for i, v in enumerate(values)], "node long, fingerprint long"
    )
    expected = groups([int(v) for v in values], list(range(len(values))))
    for limit in (3, 50, 100_000):
        found = {r.node: r.root for r in components(near_links(nodes, limit=limit)).collect()}
        assert [found.get(i, i) for i in range(len(values))] == expected


@settings(max_examples=40, deadline=None)
@given(st.integers(2, 120), st.integers(0, 6), st.integers(0, 10_000))
def test_trie_walk_agrees_with_all_pairs(count, budget, seed):
    values = near_copies(count, seed)
    one = np.array([0]), np.array([len(values)])
    label = trie_groups(values, (*one, *one, np.array([0])), 0, budget)
    assert BITS == 64
    assert label.tolist() == groups([int(v) for v in values], list(range(len(values))), budget)


def test_components_of_a_path_a_star_and_nothing(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 200 + i) for i in range(50)] + [(7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[i] == 1 for i in range(2, 41)) and all(found[200 + i] == 100 for i in range(50))
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_many_equal_texts_cost_one_node(spark):
    rows = near_duplicates(texts(spark, ["one two three four five"] * 300 + ["other words are here now"])).collect()
    assert {r.component_id for r in rows} == {0, 300}
