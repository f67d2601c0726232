"""Near-duplicate documents by SimHash and a binary trie joined with itself.

A fingerprint has 64 bits; two are linked if at most ``budget`` bits differ.
The join walks pairs of trie nodes together, adds up the bits in which their
paths differ, and leaves a pair once the budget is exceeded. Of ``budget + 1``
blocks of bits two linked fingerprints share at least one, so the trie is
built once per block with that block's bits at the top, and the walk starts at
the nodes below a whole block, paired with themselves. These nodes are what
Spark deals out; one that holds too many fingerprints is split some bits
further down, into the pairs of its descendants within the budget.

Equal fingerprints are one node of the graph, so copies are never paired.
Inside a task, pairs of nodes whose fingerprints are known to be connected are
left too, and a task returns a link from each fingerprint to the smallest of
its group, not all pairs. Components then join these links.

Defined cases: a NULL, empty or blank text has fingerprint 0, linked like any
other; rows that repeat an id are the same document, so their fingerprints are
linked; a NULL id has a fingerprint but no component; an empty table gives no
rows; only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.arrow_text import pieces, text_bytes, word_bounds
from touchline.llm.components import components
from touchline.llm.registry import query, table
from touchline.session import written

WORDS = 4
SEED = 42
BUDGET = 4
BITS = 64
# Fingerprints below one top node that a task takes; more are split further down.
NODE_LIMIT = 50_000
# Rows a task gathers before it joins them, and rows per task.
GATHERED = 500_000
ROWS_PER_TASK = 1_000_000
# Node pairs with so few fingerprint pairs are compared at once.
SMALL = 64
PAIRS_AT_ONCE = 1 << 20


def joined_words(data: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """All words, A-Z lower-cased, each followed by one blank: bytes, word starts, ends, first word per row."""
    starts, ends, first = word_bounds(data, offsets)
    lengths = ends - starts
    shift = np.repeat(starts - (np.cumsum(lengths + 1) - lengths - 1), lengths)
    out = np.full(int(lengths.sum()) + len(lengths), 0x20, np.uint8)
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    inside = np.arange(len(shift)) + np.repeat(np.arange(len(lengths)), lengths)
    letters = data[inside + shift]
    out[inside] = letters + ((letters >= 0x41) & (letters <= 0x5A)).astype(np.uint8) * 0x20
    return out.tobytes(), starts, ends, first


def shingle_hashes(
    data: np.ndarray, offsets: np.ndarray, words: int = WORDS, seed: int = SEED
) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all word shingles, and how many every row has; a shorter row is one shingle."""
    text, starts, ends, first = joined_words(data, offsets)
    counts = np.diff(first)
    shingles = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    rows = np.repeat(np.arange(len(counts)), shingles)
    at = first[rows] + np.arange(len(rows)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    until = ends[np.minimum(at + words, first[rows + 1]) - 1] if len(rows) else at
    digest = xxhash.xxh64_intdigest
    hashes = [digest(text[a:b], seed) for a, b in zip(starts[at].tolist(), until.tolist())]
    return np.array(hashes, np.uint64), shingles


def simhash(data: np.ndarray, offsets: np.ndarray, words: int = WORDS, seed: int = SEED) -> np.ndarray:
    """The fingerprint of every row: bits set in more than half the hashes of its word shingles."""
    hashes, shingles = shingle_hashes(data, offsets, words, seed)
    fingerprints = np.zeros(len(shingles), np.uint64)
    if len(hashes):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        full = np.flatnonzero(shingles)
        ones = np.add.reduceat(bits, (np.cumsum(shingles) - shingles)[full], axis=0, dtype=np.int32)
        majority = np.packbits(2 * ones > shingles[full, None], axis=1, bitorder="little")
        fingerprints[full] = majority.copy().view("<u8").ravel()
    return fingerprints


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint as long) of every row."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                found = simhash(*text_bytes(part.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fingerprint"]
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(compute, "doc_id long, fingerprint long")


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the groups of linked places; ``label`` holds each place's smallest known one."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def trie_groups(values: np.ndarray, pairs: tuple[np.ndarray, ...], depth: int, budget: int) -> np.ndarray:
    """For each value the place of the smallest-placed value connected to it by links within ``budget``.

    ``pairs`` are node pairs at ``depth``: begin and end of both ranges of
    ``values``, which is sorted inside each, and the bits that differ so far. A
    pair of a node with itself has equal ranges.
    """
    label = np.arange(len(values), dtype=np.int64)
    stack = [(depth, *pairs)]
    while stack:
        depth, alo, ahi, blo, bhi, spent = stack.pop()
        if len(alo) > PAIRS_AT_ONCE:
            half = len(alo) // 2
            stack += [(depth, *[x[half:] for x in (alo, ahi, blo, bhi, spent)])]
            alo, ahi, blo, bhi, spent = [x[:half] for x in (alo, ahi, blo, bhi, spent)]
            stack += [(depth, alo, ahi, blo, bhi, spent)]
            continue
        changes = np.cumsum(np.r_[0, label[1:] != label[:-1]])
        known = (changes[alo] == changes[ahi - 1]) & (changes[blo] == changes[bhi - 1]) & (label[alo] == label[blo])
        alo, ahi, blo, bhi, spent = [x[~known] for x in (alo, ahi, blo, bhi, spent)]
        sizes = (ahi - alo) * (bhi - blo)
        small = (sizes <= SMALL) | (depth == BITS)
        _compare(values, label, *[x[small] for x in (alo, ahi, blo, bhi)], budget)
        alo, ahi, blo, bhi, spent = [x[~small] for x in (alo, ahi, blo, bhi, spent)]
        if not len(alo):
            continue
        ones = np.concatenate([[0], np.cumsum((values >> np.uint64(BITS - 1 - depth)) & np.uint64(1), dtype=np.int64)])
        amid, bmid = ahi - (ones[ahi] - ones[alo]), bhi - (ones[bhi] - ones[blo])
        same = (alo == blo) & (ahi == bhi)
        # Equal bits keep what was spent, unequal bits add one; a node paired with itself has one mixed pair.
        children = [
            (alo, amid, blo, bmid, spent),
            (amid, ahi, bmid, bhi, spent),
            (alo, amid, bmid, bhi, spent + 1),
            *[[x[~same] for x in (amid, ahi, blo, bmid, spent + 1)]],
        ]
        merged = [np.concatenate(x) for x in zip(*children)]
        alive = (merged[0] < merged[1]) & (merged[2] < merged[3]) & (merged[4] <= budget)
        stack.append((depth + 1, *[x[alive] for x in merged]))
    return label


def _compare(
    values: np.ndarray, label: np.ndarray, alo: np.ndarray, ahi: np.ndarray, blo: np.ndarray, bhi: np.ndarray, budget: int
) -> None:
    """Compare all values of small node pairs, some at a time, and join the groups of those within the budget."""
    sizes = (ahi - alo) * (bhi - blo)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        base = ends[start] - sizes[start]
        end = max(start + 1, int(np.searchsorted(ends, base + PAIRS_AT_ONCE, "right")))
        entry = np.repeat(np.arange(start, end), sizes[start:end])
        place = np.arange(len(entry)) - (ends - sizes)[entry] + base
        width = (bhi - blo)[entry]
        a, b = alo[entry] + place // width, blo[entry] + place % width
        near = (a != b) & (np.bitwise_count(values[a] ^ values[b]) <= budget)
        _merge(label, a[near], b[near])
        start = end


def _group_links(batches: Iterator[pa.RecordBatch], depth: int, split: bool, budget: int) -> Iterator[pa.RecordBatch]:
    """Links (a, b) inside the top nodes of a sorted partition, some hundred thousand rows at a time."""

    def links(rows: pa.Table) -> pa.RecordBatch:
        values = rows["value"].to_numpy().view(np.uint64)
        nodes = rows["node"].to_numpy()
        key = rows["key"].to_numpy()
        begins = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        ends = np.r_[begins[1:], len(key)]
        if split:
            # Both descendants of a pair are beside each other; a pair of one with itself has a single range.
            top = values >> np.uint64(BITS - depth)
            change = np.cumsum(np.r_[0, top[1:] != top[:-1]])
            middle = begins + np.array([np.searchsorted(change[a:b], change[a], "right") for a, b in zip(begins, ends)])
            alone = middle == ends
            differ = np.bitwise_count(top[begins] ^ top[ends - 1]).astype(np.int64)
            itself = rows["itself"].to_numpy(zero_copy_only=False)[begins]
            keep = itself | ~alone
            blo = np.where(alone, begins, middle)
            roots = [x[keep] for x in (begins, middle, blo, ends, differ)]
        else:
            roots = [begins, ends, begins, ends, np.zeros(len(begins), np.int64)]
        label = trie_groups(values, tuple(roots), depth, budget)
        linked = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes[linked]), pa.array(nodes[label[linked]])], names=["a", "b"]
        )

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= GATHERED:
            rows = pa.Table.from_batches(held).combine_chunks()
            key = rows["key"].to_numpy()
            group = np.cumsum(np.r_[0, key[1:] != key[:-1]])
            cut = int(np.searchsorted(group, group[-1]))
            if cut:
                yield links(rows.slice(0, cut))
                held = rows.slice(cut).to_batches()
    if held and sum(b.num_rows for b in held):
        yield links(pa.Table.from_batches(held).combine_chunks())


def _rotated(value: Column, bits: int) -> Column:
    if not bits:
        return value
    return F.call_function("shiftleft", value, F.lit(bits)).bitwiseOR(F.shiftrightunsigned(value, BITS - bits))


def near_links(nodes: DataFrame, budget: int = BUDGET, limit: int = NODE_LIMIT) -> DataFrame:
    """Links (a, b) of ``nodes`` (node, fingerprint) that connect what is within ``budget`` bits.

    Fingerprints are unique. The links connect the same nodes as all pairs within the budget would.
    """
    spark = nodes.sparkSession
    sizes = [BITS // (budget + 1) + (i < BITS % (budget + 1)) for i in range(budget + 1)]
    tries = [
        F.struct(
            F.lit(i).alias("block"),
            _rotated(F.col("fingerprint"), sum(sizes[:i])).alias("value"),
        )
        for i in range(len(sizes))
    ]
    depth = min(sizes)
    rows = nodes.select("node", F.explode(F.array(*tries)).alias("t")).select("node", "t.block", "t.value")
    rows = rows.withColumn("key", F.shiftrightunsigned("value", BITS - depth) * len(sizes) + F.col("block"))
    total = nodes.count() * len(sizes)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // ROWS_PER_TASK))

    def join(dealt: DataFrame, depth: int, split: bool) -> DataFrame:
        placed = dealt.repartition(tasks, "key").sortWithinPartitions("key", "value")
        return placed.mapInArrow(lambda batches: _group_links(batches, depth, split, budget), "a long, b long")

    counted = written(rows.groupBy("key").count().where(F.col("count") > limit), "large-nodes")
    largest = counted.agg(F.max("count")).first()[0]
    if largest is None:
        return join(rows, depth, False)
    further = min(max((largest // limit).bit_length(), 1), 12)
    masks = F.array(*[F.lit(m).cast("long") for m in range(1 << further) if m.bit_count() <= budget])
    hot = rows.join(counted.select("key"), "key", "left_semi")
    below = F.shiftrightunsigned("value", BITS - depth - further).bitwiseAND(F.lit((1 << further) - 1))
    hot = hot.withColumn("below", below).withColumn("mask", F.explode(masks))
    hot = hot.withColumn("other", F.col("below").bitwiseXOR(F.col("mask")))
    pair = F.xxhash64("key", F.least("below", "other"), F.greatest("below", "other"))
    hot = hot.select("node", "value", pair.alias("key"), (F.col("below") == F.col("other")).alias("itself"))
    cold = rows.join(counted.select("key"), "key", "left_anti")
    return join(cold, depth, False).unionByName(join(hot, depth + further, True))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = BUDGET, limit: int = NODE_LIMIT
) -> DataFrame:
    """(doc_id, fingerprint in hex, component_id) of every row; the component is its smallest doc_id."""
    rows = written(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = rows.where("doc_id is not null").groupBy("fingerprint").agg(F.min("doc_id").alias("node"))
    nodes = written(nodes, "nodes")
    links = near_links(nodes, budget, limit)
    # Rows of one id with several texts are one document.
    again = rows.where("doc_id is not null").join(nodes, "fingerprint").where("doc_id <> node")
    repeated = rows.groupBy("doc_id").agg(F.min("fingerprint").alias("f"), F.max("fingerprint").alias("l")).where("f <> l")
    own = again.join(repeated.select("doc_id"), "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    found = components(links.unionByName(own))
    placed = nodes.join(found, "node", "left").select("fingerprint", F.coalesce("root", "node").alias("component"))
    hexed = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return rows.join(placed, "fingerprint", "left").select(
        "doc_id",
        hexed.alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"),
    )


@query("op1_simhash_near_dedup")
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
