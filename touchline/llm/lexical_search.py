"""Ranked lexical search by dense blocked BLAS multiplication.

A term is a maximal run of ASCII letters, ASCII digits and non-ASCII characters,
with A-Z lower-cased. Items are the stated queries; every document is scored
against every item.

One pass over the documents cuts them into terms and keeps, per document, its
number of terms and the counts of those terms that some item has. Sums of these
rows give N, L and the document frequencies. The second pass works on tiles: a
tile of items has a compact vocabulary of its own; a tile of documents becomes a
dense float64 matrix of impacts over a slice of that vocabulary; the product with
the matrix of term weights is a tile of partial scores. Weights and impacts are
whole numbers, and a slice is so narrow that no sum reaches 2 ** 53, so float64
holds every partial sum exactly; slices add up in int64. Of every tile the best
documents of each item stay, all ties at the last place included, and merge with
the best so far; ties are cut by id only in that merge. Tasks hand over at most
``k`` rows an item, which two levels of ranking merge.

Items are worked in blocks of a bounded number of terms, one block per pass, so
what tasks receive does not grow with the table of items. A block ends with the
item that fills it; one item's terms must fit a task, as its text does.

Defined cases: a NULL text has no terms; rows that repeat an id are ranked each
by itself; a NULL id ranks after all others with the same score; rows of items
that repeat an id are one item with the terms of all; items without terms, and
empty tables, give no rows; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import floor, isqrt, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.arrow_text import pieces, text_bytes
from touchline.llm.registry import query, table
from touchline.session import written

TOP = 50
# Items whose distinct terms fill one pass over the documents.
BLOCK_TERMS = 200_000
TILE_ITEMS = 64
TILE_DOCS = 1024
# Columns of a dense tile: 32 MB of impacts.
TILE_TERMS = 4096
EXACT = 1 << 53
# An impact is below 10 ** 9 / 10 ** 3.
IMPACT_BOUND = 10**6

LETTERS = np.zeros(256, bool)
for first, last in (("0", "9"), ("A", "Z"), ("a", "z")):
    LETTERS[ord(first) : ord(last) + 1] = True
LETTERS[0x80:] = True

POSTINGS = "doc_id long, n long, terms array<int>, counts array<int>"
BEST = "item int, doc_id long, score long"


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All terms of all rows, one after another, and the first term of every row (one entry more than rows)."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = LETTERS[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside[:-1]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    letters = data[inside[:-1]]
    letters = letters + ((letters >= 0x41) & (letters <= 0x5A)).astype(np.uint8) * np.uint8(0x20)
    bounds = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    terms = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(letters)])
    return terms, np.searchsorted(starts, offsets)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, "text"):
            terms, first = terms_of(*text_bytes(part.column(1)))
            rows = pa.array(np.repeat(np.arange(part.num_rows), np.diff(first)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(rows), terms.cast(pa.binary())], names=["item_id", "term"]
            )


def _postings(batches: Iterator[pa.RecordBatch], vocabulary: pa.Array) -> Iterator[pa.RecordBatch]:
    """A row per document: its terms that the vocabulary has, by their places in it, and how often each occurs."""
    width = np.int64(max(1, len(vocabulary)))
    for batch in batches:
        for part in pieces(batch, "text"):
            terms, first = terms_of(*text_bytes(part.column(1)))
            place = pc.index_in(terms, value_set=vocabulary).fill_null(-1).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(part.num_rows), np.diff(first))
            known = place >= 0
            cells, counts = np.unique(row[known] * width + place[known], return_counts=True)
            bounds = pa.array(np.searchsorted(cells, np.arange(part.num_rows + 1) * width).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(np.diff(first).astype(np.int64)),
                    pa.ListArray.from_arrays(bounds, pa.array((cells % width).astype(np.int32))),
                    pa.ListArray.from_arrays(bounds, pa.array(counts.astype(np.int32))),
                ],
                names=["doc_id", "n", "terms", "counts"],
            )


class Best:
    """The best documents of every item so far: higher scores first, then smaller ids, NULL ids last."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.item = self.score = self.doc = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        item, score, doc, null = [
            np.concatenate(x) for x in ((self.item, item), (self.score, score), (self.doc, doc), (self.null, null))
        ]
        order = np.lexsort((doc, null, -score, item))
        item, score, doc, null = item[order], score[order], doc[order], null[order]
        starts = np.flatnonzero(np.r_[True, item[1:] != item[:-1]]) if len(item) else np.zeros(0, np.int64)
        place = np.arange(len(item)) - np.repeat(starts, np.diff(np.r_[starts, len(item)]))
        kept = place < self.k
        self.item, self.score, self.doc, self.null = item[kept], score[kept], doc[kept], null[kept]

    def floors(self, items: int) -> np.ndarray:
        """The least score an item's next document needs: that of its k-th best, ties included; else 1."""
        counts = np.bincount(self.item, minlength=items)
        least = np.full(items, np.iinfo(np.int64).max)
        np.minimum.at(least, self.item, self.score)
        return np.where(counts >= self.k, least, 1)


def slices(weights: np.ndarray, widest: int) -> list[slice]:
    """Consecutive columns, so few that weights times impacts sum to less than 2 ** 53 in every row."""
    cuts, start = [], 0
    sums = np.cumsum(weights.max(axis=0, initial=0) * IMPACT_BOUND)
    while start < weights.shape[1]:
        base = sums[start - 1] if start else 0
        end = min(start + widest, max(start + 1, int(np.searchsorted(sums, base + EXACT, "left"))))
        cuts.append(slice(start, end))
        start = end
    return cuts


def tiles_of(item_terms: list[np.ndarray], weights: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Per tile of items: its first item, its compact vocabulary, and the weights (items, vocabulary)."""
    tiles = []
    for first in range(0, len(item_terms), TILE_ITEMS):
        own = item_terms[first : first + TILE_ITEMS]
        compact = np.unique(np.concatenate(own))
        matrix = np.zeros((len(own), len(compact)), np.int64)
        for i, terms in enumerate(own):
            at = np.searchsorted(compact, terms)
            matrix[i, at] = weights[terms]
        tiles.append((first, compact, matrix))
    return tiles


def _search(
    batches: Iterator[pa.RecordBatch], item_terms: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, k: int
) -> Iterator[pa.RecordBatch]:
    """The best ``k`` documents of this task for every item."""
    best = Best(k)
    tiles = [
        (first, compact, [(s, matrix[:, s].T.astype(np.float64)) for s in slices(matrix, TILE_TERMS)])
        for first, compact, matrix in tiles_of(item_terms, weights)
    ]
    for batch in batches:
        for start in range(0, batch.num_rows, TILE_DOCS):
            part = batch.slice(start, TILE_DOCS)
            counts = part.column(3).flatten().to_numpy().astype(np.int64)
            terms = part.column(2).flatten().to_numpy()
            row = np.repeat(np.arange(part.num_rows), np.diff(part.column(2).offsets.to_numpy()))
            m = 50 + (50 * part.column(1).to_numpy() * n_docs) // max(1, n_terms)
            impact = (1_000_000_000 * counts) // (1000 * counts + 20 * m[row])
            doc = part.column(0).fill_null(0).to_numpy()
            null = np.asarray(part.column(0).is_null())
            floors = best.floors(len(item_terms))
            for first, compact, parts in tiles:
                at = np.minimum(np.searchsorted(compact, terms), len(compact) - 1)
                own = compact[at] == terms
                score = np.zeros((part.num_rows, parts[0][1].shape[1]), np.int64)
                for cut, right in parts:
                    here = own & (at >= cut.start) & (at < cut.stop)
                    left = np.zeros((part.num_rows, cut.stop - cut.start))
                    left[row[here], at[here] - cut.start] = impact[here]
                    score += (left @ right).astype(np.int64)
                least = floors[first : first + score.shape[1]]
                if part.num_rows > k:
                    least = np.maximum(least, np.partition(score, part.num_rows - k, axis=0)[part.num_rows - k])
                docs, items = np.nonzero(score >= least)
                best.add(items + first, score[docs, items], doc[docs], null[docs])
    ids = pa.array(best.doc, mask=best.null)
    yield pa.RecordBatch.from_arrays(
        [pa.array(best.item.astype(np.int32)), ids, pa.array(best.score)], names=["item", "doc_id", "score"]
    )


def _ranked(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)


def _blocks(terms: DataFrame) -> list[DataFrame]:
    """Blocks of whole items (item_id, terms): hash buckets of items, packed until ``BLOCK_TERMS`` are reached."""
    rows = terms.groupBy("item_id").agg(F.array_sort(F.collect_list("term")).alias("terms"))
    buckets = 8 * -(-terms.count() // BLOCK_TERMS)
    if not buckets:
        return []
    bucket = F.pmod(F.xxhash64("item_id"), F.lit(buckets))
    packed: list[list[int]] = []
    room = 0
    # One row per bucket.
    for number, count in terms.groupBy(bucket).count().collect():
        if count > room:
            packed.append([])
            room = BLOCK_TERMS
        packed[-1].append(number)
        room -= count
    return [rows.where(bucket.isin(numbers)) for numbers in packed]


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item with a score above 0."""
    named = items.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text"))
    schema = f"item_id {named.schema['item_id'].dataType.simpleString()}, term binary"
    terms = written(named.mapInArrow(_item_terms, schema).distinct(), "item-terms")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = [_search_block(rows, written(block, "items"), k) for block in _blocks(terms)]
    if not found:
        kind = named.schema["item_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found)


def _search_block(rows: DataFrame, block: DataFrame, k: int) -> DataFrame:
    # A block of items: bounded by BLOCK_TERMS, whatever the table holds.
    held = block.collect()
    vocabulary = pa.array(sorted({bytes(t) for r in held for t in r.terms}), pa.large_binary())
    places = {t: i for i, t in enumerate(vocabulary.to_pylist())}
    item_terms = [np.array(sorted(places[bytes(t)] for t in r.terms), np.int64) for r in held]
    postings = written(rows.mapInArrow(lambda b: _postings(b, vocabulary), POSTINGS), "postings")
    n_docs, n_terms = postings.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    # One row per term of the block.
    df = dict(postings.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
    weights = np.array([floor(1000 * log((2 * n_docs + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(places))], np.int64)
    best = postings.mapInArrow(lambda b: _search(b, item_terms, weights, n_docs, n_terms, k), BEST)
    # Tasks of a group first, then groups: neither meets more than about the root of all tasks' rows.
    groups = isqrt(max(1, postings.rdd.getNumPartitions())) + 1
    merged = _ranked(best.withColumn("group", F.spark_partition_id() % groups), ["item", "group"], k)
    ranked = _ranked(merged.select("item", "doc_id", "score"), ["item"], k)
    spark = rows.sparkSession
    kind = block.schema["item_id"].dataType.simpleString()
    names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(held)], f"item int, item_id {kind}")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


_UPPER = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _listed(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_TERM}')"


SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_listed("text")} AS terms FROM documents),
totals AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM docs),
wanted AS (SELECT DISTINCT item_id, unnest({_listed("text")}) AS term FROM benchmark),
counted AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM counted GROUP BY term), totals
), scored AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // n_terms)))))::BIGINT AS score
  FROM counted JOIN wanted USING (term) JOIN weights USING (term), totals GROUP BY item_id, r, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= {TOP}
"""


@query("op11_lexical_search", SQL)
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
