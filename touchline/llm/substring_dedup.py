"""Duplicate word spans by relative Lempel-Ziv parsing against all documents with smaller ids.

A window is ``window`` consecutive words. A word goes if a window that covers it
also begins in a document with a smaller id.

Reference blocks are cut by content: the anchor of a window is the smallest hash
of its word 8-grams, so equal windows have equal anchors wherever they stand,
and consecutive windows with one anchor form a block. All blocks are indexed by
a hash of their words, with the place where each stands first: the smallest id,
then the first place in that document. Where an anchor but not its whole block
recurs, the windows of the block, which lie at the borders of factors, are
looked up one by one in the same way. A document is then parsed from left to
right: a factor begins at a block or window known from a smaller id and goes on
as long as the next one follows it both here and in the source, across the
borders of blocks. A factor is thus one row however long the copy, with its
source and the place there; it ends where the first place of what follows lies
elsewhere, so a text first seen in several documents is parsed into as many
factors. Windows are looked up by hash only at first occurrences and borders; a
passage in very many documents is settled by its blocks.

Hashes have 96 bits. Counting by hash adds up before the shuffle, and no list
grows beyond what one document holds.

Defined cases: a NULL text has no words; fewer words than a window are all
kept; rows that repeat an id never remove words of each other; a row with a
NULL id keeps all its words and removes none; an empty table gives no rows; only
the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.arrow_text import pieces, text_bytes, word_bounds
from touchline.llm.hot_keys import join_counted
from touchline.llm.registry import query, table
from touchline.llm.word_hash import between, running, word_hashes
from touchline.session import written

WINDOW = 50
GRAM = 8

BLOCKS = "doc_id long, variant int, anchor long, block long, check int, `from` int, `to` int"
WINDOWS = "doc_id long, variant int, seq long, check int, place int"
FACTOR = "`from`: int, `to`: int, source_id: long, source_variant: int, source_from: int"


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """The picked one of ``width`` values from each place on; shorter at the end by width - 1."""
    size, best = 1, values
    while size * 2 <= width:
        best = pick(best[:-size], best[size:])
        size *= 2
    rest = width - size
    return pick(best[: len(best) - rest], best[rest:]) if rest else best


class Parsed:
    """Words of some rows, and the blocks of their windows.

    ``starts`` and ``ends`` are the first and last window of every block, as
    places among the words of all rows together, ``rows`` the row it lies in.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> None:
        word_starts, word_ends, self.first = word_bounds(data, offsets)
        n = len(word_starts)
        self.sums = running(word_hashes(data, word_starts, word_ends))
        last = np.repeat(self.first[1:], np.diff(self.first))
        begins = np.flatnonzero(np.arange(n) + window <= last)
        self.starts = self.ends = self.rows = self.anchors = begins
        if not len(begins):
            return
        at = np.arange(n - gram + 1)
        least = _slide(between(self.sums, at, at + gram), window - gram + 1, np.minimum)[begins]
        row = np.searchsorted(self.first, begins, "right") - 1
        new = np.flatnonzero(np.r_[True, (least[1:] != least[:-1]) | (row[1:] != row[:-1])])
        self.starts, self.ends = begins[new], begins[np.r_[new[1:], len(begins)] - 1]
        self.rows, self.anchors = row[new], least[new].view(np.int64)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """64 bits of each word sequence and 32 more, from the hashes of its halves."""
        middle = (starts + ends + 1) // 2
        halves = between(self.sums, starts, middle) * np.uint64(3) + between(self.sums, middle, ends)
        return between(self.sums, starts, ends).view(np.int64), (halves >> np.uint64(32)).astype(np.uint32).view(np.int32)

    def in_row(self, places: np.ndarray, rows: np.ndarray) -> pa.Array:
        return pa.array((places - self.first[rows]).astype(np.int32))


def _blocks(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, "text"):
            p = Parsed(*text_bytes(part.column(2)), window, gram)
            block, check = p.hashes(p.starts, p.ends + window)
            columns = [
                part.column(0).take(pa.array(p.rows)),
                part.column(1).take(pa.array(p.rows)),
                pa.array(p.anchors, pa.int64()),
                pa.array(block),
                pa.array(check),
                p.in_row(p.starts, p.rows),
                p.in_row(p.ends, p.rows),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "variant", "anchor", "block", "check", "from", "to"])


def _open_windows(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Windows of the blocks that begin at the places listed as ``open``."""
    for batch in batches:
        for part in pieces(batch, "text"):
            p = Parsed(*text_bytes(part.column(2)), window, gram)
            listed = part.column(part.schema.get_field_index("open"))
            places = listed.flatten().to_numpy() + np.repeat(p.first[:-1], np.diff(listed.offsets.to_numpy()))
            at = np.flatnonzero(np.isin(p.starts, places))
            sizes = (p.ends - p.starts + 1)[at]
            row = np.repeat(p.rows[at], sizes)
            starts = np.repeat(p.starts[at] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
            seq, check = p.hashes(starts, starts + window)
            columns = [
                part.column(0).take(pa.array(row)),
                part.column(1).take(pa.array(row)),
                pa.array(seq),
                pa.array(check),
                p.in_row(starts, row),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "variant", "seq", "check", "place"])


def _first_places(rows: DataFrame, keys: list[str], place: str, name: str) -> DataFrame:
    """Where every hash found in several documents stands first, and how many rows have it."""
    first = F.min(F.struct("doc_id", "variant", place)).alias("first")
    counted = rows.groupBy(*keys).agg(first, F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("n"))
    places = counted.where("first.doc_id < hi").select(
        *keys,
        F.col("first.doc_id").alias("source_id"),
        F.col("first.variant").alias("source_variant"),
        F.col(f"first.{place}").alias("source_from"),
        "n",
    )
    return written(places, name)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Factors of every document from its known blocks and windows, in one pass from left to right."""
    for batch in batches:
        known = batch.column(2)
        row = np.repeat(np.arange(batch.num_rows), np.diff(known.offsets.to_numpy()))
        unit = {f.name: v.to_numpy(zero_copy_only=False) for f, v in zip(known.type.value_type, known.flatten().flatten())}
        order = np.lexsort((unit["from"], row))
        row, unit = row[order], {name: v[order] for name, v in unit.items()}
        goes_on = np.zeros(len(row), bool)
        goes_on[1:] = (row[1:] == row[:-1]) & (unit["from"][1:] == unit["to"][:-1] + 1)
        shift = unit["from"] - unit["source_from"]
        for same in (unit["source_id"], unit["source_variant"], shift):
            goes_on[1:] &= same[1:] == same[:-1]
        begins = np.flatnonzero(~goes_on)
        ends = np.r_[begins[1:], len(row)] - 1 if len(begins) else begins
        unit = {name: v[begins] if name != "to" else v[ends] for name, v in unit.items()}
        at = np.searchsorted(row[begins], np.arange(batch.num_rows + 1)).astype(np.int32)
        fields = [pa.field("from", pa.int32()), pa.field("to", pa.int32()), pa.field("source_id", pa.int64())]
        fields += [pa.field("source_variant", pa.int32()), pa.field("source_from", pa.int32())]
        factors = pa.StructArray.from_arrays([pa.array(unit[f.name], f.type) for f in fields], fields=fields)
        lists = pa.ListArray.from_arrays(pa.array(at), factors)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["doc_id", "variant", "factors"])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.hash(text_col).alias("variant"),
        F.col(text_col).alias("text"),
    )


def _parsed(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """(doc_id, variant, factors) of every text with a factor."""
    named = rows.where("doc_id is not null")
    blocks = written(named.mapInArrow(lambda b: _blocks(b, window, gram), BLOCKS), "blocks")
    recurring = (
        blocks.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("anchor")
    )
    shared = written(blocks.join(recurring, "anchor", "left_semi").drop("anchor"), "shared-blocks")
    index = _first_places(shared, ["block", "check"], "from", "index")
    found = [F.col(name) for name in ("doc_id", "variant", "from", "to", "source_id", "source_variant", "source_from")]
    known = written(join_counted(shared, index, ["block", "check"], "n").where("source_id < doc_id").select(*found), "known")
    spans = ["doc_id", "variant", "from"]
    unknown = shared.select(*spans).join(known.select(*spans), spans, "left_anti")
    borders = unknown.groupBy("doc_id", "variant").agg(F.collect_set("from").alias("open"))
    open_ = rows.join(borders, ["doc_id", "variant"]).mapInArrow(lambda b: _open_windows(b, window, gram), WINDOWS)
    open_ = written(open_, "windows")
    places = _first_places(open_, ["seq", "check"], "place", "places")
    single = open_.withColumns({"from": F.col("place"), "to": F.col("place")})
    single = join_counted(single, places, ["seq", "check"], "n").where("source_id < doc_id").select(*found)
    units = known.unionByName(single).groupBy("doc_id", "variant").agg(F.collect_set(F.struct(*found[2:])).alias("units"))
    return units.mapInArrow(_parse, f"doc_id long, variant int, factors array<struct<{FACTOR}>>")


def factor_table(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, variant, from, n_words, source_id, source_variant, source_from): the parse, a row per factor.

    The ``n_words`` words from ``from`` on are those of the source from
    ``source_from`` on; places count words from 0. ``variant`` hashes the text, for
    ids with several.
    """
    parsed = _parsed(_keyed(docs, id_col, text_col), window, gram).select("doc_id", "variant", F.inline("factors"))
    n_words = (F.col("to") - F.col("from") + window).alias("n_words")
    return parsed.select("doc_id", "variant", "from", n_words, "source_id", "source_variant", "source_from")


KEPT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def remove_duplicates(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_text: bool = True,
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, ``with_text``, the kept words of every row."""
    rows = _keyed(docs, id_col, text_col)
    spans = _parsed(rows, window, gram).select(
        "doc_id",
        "variant",
        F.col("factors.from").cast("array<long>").alias("starts"),
        F.col("factors.to").cast("array<long>").alias("ends"),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                yield _cut(part, window, with_text)

    return rows.join(spans, ["doc_id", "variant"], "left").mapInArrow(cut, KEPT)


def _cut(part: pa.RecordBatch, window: int, with_text: bool) -> pa.RecordBatch:
    data, offsets = text_bytes(part.column(part.schema.get_field_index("text")))
    starts, ends, first = word_bounds(data, offsets)
    bounds = []
    for name in ("starts", "ends"):
        column = part.column(part.schema.get_field_index(name))
        bounds.append(column.flatten().to_numpy(zero_copy_only=False) + np.repeat(first[:-1], np.diff(column.offsets.to_numpy())))
    depth = np.zeros(len(starts) + 1, np.int64)
    np.add.at(depth, bounds[0].astype(np.int64), 1)
    np.add.at(depth, bounds[1].astype(np.int64) + window, -1)
    kept = np.cumsum(depth)[:-1] == 0
    counts = np.concatenate([[0], np.cumsum(kept)])
    lengths = (ends - starts + 1)[kept]
    # Kept words one after another, each followed by a blank.
    size = int(lengths.sum())
    out = np.full(size, 0x20, np.uint8)
    until = np.cumsum(lengths)
    letters = np.repeat(starts[kept] - (until - lengths), lengths) + np.arange(size)
    inside = np.ones(size, bool)
    inside[until - 1] = False
    out[inside] = data[letters[inside]]
    text = out.tobytes()
    until = np.concatenate([[0], until])
    kept_texts = [
        text[a : max(a, b - 1)] for a, b in zip(until[counts[first[:-1]]].tolist(), until[counts[first[1:]]].tolist())
    ]
    words = np.diff(first)
    return pa.RecordBatch.from_arrays(
        [
            part.column(part.schema.get_field_index("doc_id")),
            pa.array(words.astype(np.int64)),
            pa.array((words - np.diff(counts[first])).astype(np.int64)),
            pa.array([hashlib.sha256(t).hexdigest() for t in kept_texts]),
            pa.array([t.decode() if with_text else None for t in kept_texts], pa.string()),
        ],
        names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
    )


SQL = f"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents
), starts AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + {WINDOW - 1}], ' ')) AS seq
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM words WHERE len(w) >= {WINDOW})
), dup AS (
  SELECT doc_id, i FROM starts JOIN (SELECT seq, min(doc_id) AS earliest FROM starts GROUP BY seq) USING (seq)
  WHERE earliest < doc_id
), gone AS (SELECT DISTINCT doc_id, i + k AS i FROM dup, (SELECT unnest(range({WINDOW})) AS k)
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
  FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words) ANTI JOIN gone USING (doc_id, i)
  GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""


@query("op7_substring_dedup", SQL)
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_duplicates(table(spark, sf_dir, "documents"), with_text=False)
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")
