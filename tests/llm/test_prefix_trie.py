"""The trie of prefixes against plain Python, with long sequences, copies and odd rows."""

import hashlib
import random
import zlib

from touchline.llm import hot_keys
from touchline.llm.prefix_trie import GROUP, SHARED, prefix_trie, rebuilt

SCHEMA = "conv_id long, turn long, role string, text string, name string, span long"


def plain_rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn, role or "", text or ""))
    for turns in own.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.md5(t[2].encode()).hexdigest()))
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % SHARED
        made[c] = [t[1:] for t in own.get(c - c % GROUP, [])[:h]] + [t[1:] for t in turns[h:]]
    return made


def plain_trie(made):
    nodes = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    parents = {}
    for node in nodes:
        if node:
            parents.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(nodes, key=len, reverse=True):
        own = (len(nodes[node]) - 1) * len(node[-1][1].encode()) if node else 0
        below = parents.get(node, [])
        leaves[node] = sum(leaves[x] for x in below) or 1
        saved[node] = own + sum(saved[x] for x in below)
    found = []
    for node, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in members if len(made[c]) == len(node)))
        parent = min(nodes[node[:-1]]) if node else None
        found.append(
            (min(members), len(node), parent, len(members), len(parents.get(node, [])), leaves[node], saved[node],
             hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(found, key=lambda r: r[:2])


def trie_of(spark, rows):
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in prefix_trie(*rebuilt(df)).collect()), key=lambda r: r[:2])


def some_rows(rng, convs, longest):
    rows = []
    for c in range(convs):
        n = rng.choice([0, 1, 2, 3, 4, 6, 9, longest])
        for turn in range(n):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(["ja", "né", "", None])))
    return rows


def test_agrees_with_plain_python(spark):
    rows = some_rows(random.Random(150), 60, 150)
    assert trie_of(spark, rows) == plain_trie(plain_rebuilt(rows))


def test_long_shared_prefixes_that_part_late(spark):
    """Sequences that share far more turns than a range has, so that grafts reach over several levels."""
    rng = random.Random(5)
    trunk = [("user", f"turn {i}") for i in range(140)]
    made = {}
    for c in range(0, 200, 5):
        keep = rng.choice([15, 16, 17, 31, 32, 33, 63, 64, 65, 100, 127, 128, 129, 140])
        made[c] = trunk[:keep] + [("user", rng.choice("abc")) for _ in range(rng.randrange(0, 40))]
    rows = [(c, i, *t) for c, turns in made.items() for i, t in enumerate(turns)]
    rng.shuffle(rows)
    assert trie_of(spark, rows) == plain_trie(plain_rebuilt(rows)) == plain_trie(made)


def test_copies_and_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(hot_keys, "HOT_ROWS", 3)
    rows = [(c, i, "user", f"t{i}") for c in range(40) for i in range(4)] + [(100, i, "user", f"long {i % 7}") for i in range(300)]
    rows += [(c, 0, "user", f"only {c}") for c in range(200, 230)]
    assert trie_of(spark, rows) == plain_trie(plain_rebuilt(rows))


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "no id"),
        (3, None, "user", "first"),
        (3, None, None, None),
        (3, 1, "user", "b"),
        (3, 1, "user", "b"),
        (3, 1, "assistant", "a"),
        (3, -2, "user", "w " * 50_000),
        (7, 0, "user", "only"),
        (8, 0, None, ""),
        (-9, 0, "user", "negative"),
    ]
    found = trie_of(spark, rows)
    # Remainders keep the sign, as they do in Spark.
    expected = plain_rebuilt([r for r in rows if r[0] != -9])
    h = zlib.crc32(b"-9") % SHARED
    expected[-9] = [("user", "negative")][h:]
    assert found == plain_trie(expected)
    assert trie_of(spark, [(None, 1, "user", "x")]) == [] == trie_of(spark, [])
