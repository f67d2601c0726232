"""Duplicate byte strings by prefix-free parsing: orders of a dictionary and of what follows make the corpus order.

A byte goes if a string of ``window`` bytes that covers it also starts anywhere
else, in another document or the same one.

Triggers cut the text: a place is one if the rolling hash of its ``gram`` bytes is
the least, the leftmost of equals, inside some window. Each window thus has one
trigger, which its own bytes decide, so equal windows have equal triggers at equal
distances. Consecutive windows of one trigger form a phrase, which holds all their
bytes; every window lies in exactly one phrase. The distinct phrases are the
dictionary, and each is compared once, however often it occurs:

* a phrase that occurs again makes all its windows duplicates,
* a phrase whose trigger's bytes occur nowhere else has none,
* all others are put in corpus order, trigger by trigger. A window that begins l
  bytes before its trigger is a suffix of the phrase's head, l bytes long, and a
  prefix of its tail. The reversed heads, sorted, are the suffix array of the
  dictionary up to the trigger; the tails, sorted, that of what the parse goes on
  with there; the common prefixes of neighbours in both make classes of heads
  that agree in l bytes and of tails that agree in the other ``window - l``.
  Windows of one class in both stand side by side in corpus order with ``window``
  bytes in common. This takes one sort of either for all l, not one per window.

Bytes decide inside a trigger's group, two hashes of 64 bits, of the trigger and
of the phrase, whether whole phrases are equal. Occurrences are counted before they are shuffled; the few triggers and
phrases with more than a thousandth of all rows are joined by broadcast. A
trigger with very many distinct phrases, such as a very common line with ever
different neighbours, is not one group: its windows are dealt out by their own
hashes instead, counted the same way.

Defined cases: a NULL text is empty; fewer bytes than a window are all kept; rows
that repeat an id are documents of their own, so equal rows remove each other; a
NULL id is treated like any other; an empty table gives no rows; only the id and
text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.arrow_text import pieces, text_bytes
from touchline.llm.hot_keys import join_counted
from touchline.llm.registry import query, table
from touchline.llm.word_hash import BYTE_VALUES, between, running
from touchline.session import written

WINDOW = 200
GRAM = 32
# Distinct phrases of a trigger that are ordered in one group; windows of a trigger with more are dealt out.
GROUP_LIMIT = 20_000
# Phrases a task gathers before it orders them.
GATHERED = 20_000
LOW = np.uint64((1 << 32) - 1)

# Text a task parses at a time.
PIECE = 1 << 18

PHRASES = "id long, variant int, anchor long, phrase long, place long"
CONTEXTS = (
    "dealt boolean, anchor long, check int, n long, id long, variant int, at int, lo int, hi int, head binary, tail binary"
)
SPANS = "id long, variant int, span long"


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` values from each place on."""
    size, best = 1, values
    while size * 2 <= width:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    rest = width - size
    return np.minimum(best[: len(best) - rest], best[rest:]) if rest else best


class Parse:
    """Phrases of some rows: trigger, first and last window as places among the bytes of all rows, and the row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> None:
        self.offsets, self.window, self.gram = offsets, window, gram
        self.sums = running(BYTE_VALUES[data])
        begins = np.zeros(len(data) + 1, np.int32)
        long = np.flatnonzero(np.diff(offsets) >= window)
        np.add.at(begins, offsets[long], 1)
        np.add.at(begins, offsets[long + 1] - window + 1, -1)
        begins = np.flatnonzero(np.cumsum(begins)[:-1])
        self.at = self.starts = self.ends = self.rows = begins
        if not len(begins):
            return
        place = np.arange(len(data) - gram + 1)
        ranked = (between(self.sums, place, place + gram) & ~LOW) | place.astype(np.uint64)
        trigger = (_least(ranked, window - gram + 1)[begins] & LOW).astype(np.int64)
        # A trigger never lies before its window, so phrases of different rows have different ones.
        new = np.flatnonzero(np.r_[True, trigger[1:] != trigger[:-1]])
        self.at, self.starts = trigger[new], begins[new]
        self.ends = begins[np.r_[new[1:], len(begins)] - 1]
        self.rows = np.searchsorted(offsets, self.starts, "right") - 1

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """64 bits of each byte string and 32 more, from the hashes of its halves."""
        middle = (starts + ends + 1) // 2
        halves = between(self.sums, starts, middle) * np.uint64(3) + between(self.sums, middle, ends)
        return between(self.sums, starts, ends).view(np.int64), (halves >> np.uint64(32)).astype(np.uint32).view(np.int32)

    def places(self) -> np.ndarray:
        """First window in its row, windows but one, and distance of the trigger from the first, as one number."""
        first = self.starts - self.offsets[self.rows]
        return (first * self.window + self.ends - self.starts) * self.window + self.at - self.starts


def _phrases(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, "text", PIECE):
            p = Parse(*text_bytes(part.column(2)), window, gram)
            row = pa.array(p.rows)
            columns = [
                part.column(0).take(row),
                part.column(1).take(row),
                pa.array(between(p.sums, p.at, p.at + gram).view(np.int64)),
                pa.array(between(p.sums, p.starts, p.ends + window).view(np.int64)),
                pa.array(p.places()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "variant", "anchor", "phrase", "place"])


def _contexts(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Heads and tails of the listed phrases, or, of those to be dealt out, the hashes of their windows."""
    for batch in batches:
        for part in pieces(batch, "text", PIECE):
            data, offsets = text_bytes(part.column(2))
            raw = data.tobytes()
            listed = part.column(3)
            row = np.repeat(np.arange(part.num_rows), np.diff(listed.offsets.to_numpy()))
            fields = listed.flatten()
            anchor, n, dealt, place = [
                fields.field(i).to_numpy(zero_copy_only=False) for i in ("anchor", "n", "dealt", "place")
            ]
            dealt = dealt.astype(bool)
            first = place // window**2
            last, at = first + place // window % window, (first + place % window).astype(np.int32)
            base = offsets[row]
            for kept, deal in ((np.flatnonzero(~dealt), False), (np.flatnonzero(dealt), True)):
                if not len(kept):
                    continue
                r, a, b, t = row[kept], (base + first)[kept], (base + last)[kept], (base + at)[kept]
                if deal:
                    sizes = b - a + 1
                    entry = np.repeat(np.arange(len(kept)), sizes)
                    start = np.arange(len(entry)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + a[entry]
                    p = Parse(data, offsets, window, window)
                    key, check = p.hashes(start, start + window)
                    r, kept = r[entry], kept[entry]
                    lo = (start - base[kept]).astype(np.int32)
                    hi, head, tail = lo, [None] * len(kept), [None] * len(kept)
                else:
                    key, check = anchor[kept], np.zeros(len(kept), np.int32)
                    lo, hi = (t - b).astype(np.int32), (t - a).astype(np.int32)
                    head = [raw[x:y][::-1] for x, y in zip(a.tolist(), t.tolist())]
                    tail = [raw[x : y + window] for x, y in zip(t.tolist(), b.tolist())]
                rows = pa.array(r)
                columns = [
                    pa.array(np.full(len(kept), deal)),
                    pa.array(key),
                    pa.array(check),
                    pa.array(n[kept]),
                    part.column(0).take(rows),
                    part.column(1).take(rows),
                    pa.array(at[kept]),
                    pa.array(lo),
                    pa.array(hi),
                    pa.array(head, pa.binary()),
                    pa.array(tail, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, names=["dealt", "anchor", "check", "n", "id", "variant", "at", "lo", "hi", "head", "tail"]
                )


def _padded(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Byte strings as rows of a matrix, zeros after their ends."""
    values = column.combine_chunks().cast(pa.large_binary())
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    sizes = np.diff(offsets)
    matrix = np.zeros((len(sizes), width), np.uint8)
    if sizes.sum():
        data = np.frombuffer(values.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        row = np.repeat(np.arange(len(sizes)), sizes)
        matrix[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = data
    return matrix


def suffix_order(matrix: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted order of the rows inside their groups, and the common prefix of each with the one before (-1: none)."""
    words = matrix.view(">u8")
    order = np.lexsort([*[words[:, i] for i in range(words.shape[1] - 1, -1, -1)], group])
    placed = matrix[order]
    differ = placed[1:] != placed[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), matrix.shape[1])
    common[group[order][1:] != group[order][:-1]] = -1
    return order, np.r_[-1, common]


def equal_windows(
    group: np.ndarray, heads: np.ndarray, tails: np.ndarray, lo: np.ndarray, hi: np.ndarray, window: int
) -> np.ndarray:
    """(phrase, l): whether the window that begins l bytes before the trigger is also one of another phrase of the group."""
    found = np.zeros((len(group), int(hi.max()) + 1), bool)
    head_order, head_common = suffix_order(heads, group)
    tail_order, tail_common = suffix_order(tails, group)
    head_class, tail_class = np.empty(len(group), np.int64), np.empty(len(group), np.int64)
    for before in range(int(lo.min()), found.shape[1]):
        own = np.flatnonzero((lo <= before) & (hi >= before))
        if len(own) < 2:
            continue
        head_class[head_order] = np.cumsum(head_common < before)
        tail_class[tail_order] = np.cumsum(tail_common < window - before)
        pair = head_class[own] * (len(group) + 1) + tail_class[own]
        order = np.argsort(pair)
        same = pair[order][1:] == pair[order][:-1]
        found[own[order][np.r_[False, same] | np.r_[same, False]], before] = True
    return found


def _ordered(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Duplicate windows, as spans, of the phrases that occur once; the rows of a trigger follow one another."""

    def spans(rows: pa.Table) -> pa.RecordBatch:
        anchor = rows["anchor"].to_numpy()
        group = np.cumsum(np.r_[0, anchor[1:] != anchor[:-1]])
        lo, hi, at = [rows[c].to_numpy() for c in ("lo", "hi", "at")]
        # Words of 8 bytes are compared; tails hold at most window bytes, heads fewer.
        width = -(-window // 8) * 8
        found = equal_windows(group, _padded(rows["head"], width), _padded(rows["tail"], width), lo, hi, window)
        found[rows["n"].to_numpy() > 1] = False
        edges = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, first = np.nonzero(edges == 1)
        _, last = np.nonzero(edges == -1)
        taken = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [
                rows["id"].combine_chunks().take(taken),
                rows["variant"].combine_chunks().take(taken),
                # The first window of the run, and how many follow it.
                pa.array((at[row] - last + 1).astype(np.int64) * window + last - 1 - first),
            ],
            names=["id", "variant", "span"],
        )

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= GATHERED:
            rows = pa.Table.from_batches(held).combine_chunks()
            anchor = rows["anchor"].to_numpy()
            changes = np.flatnonzero(anchor[1:] != anchor[:-1])
            if len(changes):
                cut = int(changes[-1]) + 1
                yield spans(rows.slice(0, cut).combine_chunks())
                held = rows.slice(cut).to_batches()
    if held and sum(b.num_rows for b in held):
        yield spans(pa.Table.from_batches(held).combine_chunks())


def duplicate_windows(rows: DataFrame, window: int = WINDOW, gram: int = GRAM, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """(id, variant, span): runs of windows each of which also begins elsewhere.

    ``rows`` are (id, variant, text); id and variant together name a row. A span
    is the place of its first window times ``window``, plus the windows that follow it.
    """
    phrases = written(rows.mapInArrow(lambda b: _phrases(b, window, gram), PHRASES), "phrases")
    several = (F.min("phrase") != F.max("phrase")).alias("several")
    anchors = phrases.groupBy("anchor").agg(F.count(F.lit(1)).alias("total"), several)
    anchors = written(anchors.where("total > 1"), "anchors")
    shared = written(join_counted(phrases, anchors, ["anchor"], "total"), "shared-phrases")
    whole = ["id", "variant", F.expr(f"place div {window}").alias("span")]
    # All occurrences of a trigger in one phrase: nothing to compare.
    alike = shared.where("not several").select(*whole)
    several = shared.where("several")
    first = F.min(F.struct("id", "variant", "place")).alias("first")
    dictionary = several.groupBy("anchor", "phrase").agg(F.count(F.lit(1)).alias("n"), first)
    dictionary = written(dictionary, "dictionary")
    again = dictionary.where("n > 1").select("anchor", "phrase", "n")
    again = join_counted(several, again, ["anchor", "phrase"], "n", "left_semi").select(*whole)
    large = dictionary.groupBy("anchor").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > group_limit)
    # Triggers with so many distinct phrases are at most dictionary / group_limit; small tables are broadcast by their size.
    large = written(large.select("anchor", F.lit(True).alias("dealt")), "large-groups")
    open_ = dictionary.join(large, "anchor", "left").select(
        "first.id",
        "first.variant",
        F.struct("anchor", "n", F.coalesce("dealt", F.lit(False)).alias("dealt"), "first.place").alias("p"),
    )
    open_ = open_.groupBy("id", "variant").agg(F.collect_list("p").alias("phrases"))
    contexts = rows.join(open_, ["id", "variant"]).mapInArrow(lambda b: _contexts(b, window), CONTEXTS)
    some_dealt = not large.isEmpty()
    if some_dealt:
        contexts = written(contexts, "contexts")
    grouped = contexts.where("not dealt").repartition("anchor").sortWithinPartitions("anchor")
    spans = alike.unionByName(again).unionByName(grouped.mapInArrow(lambda b: _ordered(b, window), SPANS))
    if some_dealt:
        dealt = contexts.where("dealt")
        counted = dealt.groupBy("anchor", "check").agg(F.count(F.lit(1)).alias("windows")).where("windows > 1")
        found = join_counted(dealt.where("n = 1"), written(counted, "windows"), ["anchor", "check"], "windows", "left_semi")
        spans = spans.unionByName(found.select("id", "variant", (F.col("lo").cast("long") * window).alias("span")))
    return spans


KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _cut(part: pa.RecordBatch, window: int, with_kept: bool) -> pa.RecordBatch:
    data, offsets = text_bytes(part.column(part.schema.get_field_index("text")))
    spans = part.column(part.schema.get_field_index("spans"))
    base = np.repeat(offsets[:-1], np.diff(spans.offsets.to_numpy()))
    first, more = np.divmod(spans.flatten().to_numpy(zero_copy_only=False).astype(np.int64), window)
    depth = np.zeros(len(data) + 1, np.int32)
    np.add.at(depth, base + first, 1)
    np.add.at(depth, base + first + more + window, -1)
    gone = np.cumsum(depth)[:-1] > 0
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = gone & (~np.r_[False, gone[:-1]] | edge[:-1])
    removed, spans = [np.concatenate([[0], np.cumsum(x, dtype=np.int64)])[offsets] for x in (gone, begins)]
    kept = data[~gone].tobytes()
    bounds = (offsets - removed).tolist()
    kept = [kept[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    return pa.RecordBatch.from_arrays(
        [
            part.column(part.schema.get_field_index("doc_id")),
            pa.array(np.diff(offsets)),
            pa.array(np.diff(removed)),
            pa.array(np.diff(spans)),
            pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            pa.array([k if with_kept else None for k in kept], pa.binary()),
        ],
        names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
    )


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    group_limit: int = GROUP_LIMIT,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_kept: bool = True,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, ``with_kept``, the remaining bytes of every row."""
    named = F.col(id_col).cast("long")
    rows = docs.select(
        F.coalesce(named, F.xxhash64(text_col)).alias("id"),
        F.hash(named.isNull(), F.col(text_col)).alias("variant"),
        F.col(text_col).alias("text"),
        named.alias("doc_id"),
    )
    spans = duplicate_windows(rows.drop("doc_id"), window, gram, group_limit)
    spans = spans.groupBy("id", "variant").agg(F.collect_list("span").alias("spans"))
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", PIECE):
                yield _cut(part, window, with_kept)

    return rows.join(spans, ["id", "variant"], "left").mapInArrow(cut, KEPT)


SQL = f"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS t, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), windows AS MATERIALIZED (
  SELECT r, i, md5(t[i + 1:i + {WINDOW}]) AS w FROM (SELECT r, t, unnest(range(0, n - {WINDOW - 1})) AS i FROM docs WHERE n >= {WINDOW})
), dup AS (SELECT r, i FROM windows WHERE w IN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1)),
marked AS (SELECT r, i, coalesce(i > lag(i) OVER (PARTITION BY r ORDER BY i) + {WINDOW}, true)::INT AS new FROM dup),
runs AS (
  SELECT r, min(i) AS a, max(i) + {WINDOW} AS b
  FROM (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS run FROM marked) GROUP BY r, run
), gaps AS (
  SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS x, a AS y FROM runs
  UNION ALL SELECT r, coalesce(max(b), 0), any_value(n) FROM docs LEFT JOIN runs USING (r) GROUP BY r
), kept AS (SELECT r, string_agg(hex(t[x + 1:y]), '' ORDER BY x) AS h FROM gaps JOIN docs USING (r) WHERE y > x GROUP BY r),
sums AS (SELECT r, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM runs GROUP BY r)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(h, ''))) AS kept_sha256
FROM docs LEFT JOIN kept USING (r) LEFT JOIN sums USING (r)
"""


@query("op12_suffix_dedup", SQL)
def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(table(spark, sf_dir, "documents"), with_kept=False)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
