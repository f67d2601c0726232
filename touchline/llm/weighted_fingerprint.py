"""Document fingerprints by consistent weighted sampling.

A text is a set of words weighted by their counts. For each of ``SAMPLES``
samples a word has r and c from a gamma distribution with shape 2 and b uniform in [0, 1),
all from a hash of the word and the sample's number. With weight w, t = floor(ln w / r + b)
and ln a = ln c - r (t - b + 1); the word with the least a is drawn together with t.
Two texts draw the same with the probability of their generalised Jaccard
similarity, the sum over words of the smaller weight over that of the larger
weight. A fingerprint keeps 16 bits of each draw, so one in 65,536 unequal draws looks equal;
likeness is the share of equal draws.

Neighbours by id meet without a second shuffle of texts: rows are dealt by
ranges of the id, and the first row of each range also goes, marked as a copy,
to the end of the range before it (of the first range to the last). A task then
reads its sorted rows once, keeping a megabyte or so of text.

Defined cases: a NULL text counts as empty; a text without words has the
all-zero fingerprint, and two such texts have likeness 1; NULL ids come first,
rows that repeat an id are neighbours of each other, ordered by a hash of the
text; a single row is its own neighbour; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.arrow_text import text_bytes, word_bounds
from touchline.llm.registry import query, table
from touchline.llm.word_hash import BASE, mixed, word_hashes
from touchline.session import written

SAMPLES = 64
CODE_BYTES = 2
# Text compared at a time, in characters, and words whose samples are drawn at a time.
CHUNK_CHARS = 1 << 20
TERMS_AT_ONCE = 512
# Ranges per scan partition; several lie in one task, which evens out their sizes.
RANGES = 4
TERM_BITS = 44
SAMPLE_SALTS = mixed(np.arange(1, SAMPLES + 1, dtype=np.uint64))

PAIRS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def drawn(terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r, b and ln c of every term and sample.

    Two hashes give four uniform numbers of 24 bits and one of 16; minus the
    logarithm of the product of two is gamma distributed with shape 2.
    """
    seed = terms[:, None] * BASE ^ SAMPLE_SALTS[None, :]
    one, two = mixed(seed), mixed(seed + BASE)
    unit = [((h >> np.uint64(s)) & np.uint64(0xFFFFFF)).astype(np.float32) for h in (one, two) for s in (40, 16)]
    logs = [np.log((u + np.float32(0.5)) * np.float32(2**-24)) for u in unit]
    b = (one & np.uint64(0xFFFF)).astype(np.float32) * np.float32(2**-16)
    return -(logs[0] + logs[1]), b, np.log(-(logs[2] + logs[3]))


def weighted_terms(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms, their counts, and the first term of every text; terms ascend within a text."""
    data, offsets = text_bytes(pa.array(texts, pa.large_string()))
    starts, ends, first = word_bounds(data, offsets)
    word = word_hashes(data, starts, ends) >> np.uint64(64 - TERM_BITS)
    text = np.repeat(np.arange(len(texts), dtype=np.uint64), np.diff(first))
    word = np.sort(text << np.uint64(TERM_BITS) | word)
    at = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else np.zeros(0, np.int64)
    counts = np.diff(np.r_[at, len(word)])
    word = word[at]
    begins = np.searchsorted(word >> np.uint64(TERM_BITS), np.arange(len(texts) + 1, dtype=np.uint64))
    return word & np.uint64((1 << TERM_BITS) - 1), counts, begins


def signatures(texts: list[str]) -> np.ndarray:
    """A row of 16-bit codes per text."""
    codes = np.zeros((len(texts), SAMPLES), np.uint16)
    terms, counts, begins = weighted_terms(texts)
    full = np.flatnonzero(np.diff(begins))
    if not len(full):
        return codes
    distinct, place = np.unique(terms, return_inverse=True)
    # With weight 1, t is 0 and a needs no logarithm of the weight.
    single = np.empty((len(distinct), SAMPLES), np.float32)
    heavy = np.flatnonzero(counts > 1)
    heavy_terms, heavy_place = np.unique(place[heavy], return_inverse=True)
    parts = []
    for i in range(0, len(distinct), TERMS_AT_ONCE):
        r, b, c = drawn(distinct[i : i + TERMS_AT_ONCE])
        single[i : i + TERMS_AT_ONCE] = c - r * (1 - b)
        kept = heavy_terms[np.searchsorted(heavy_terms, i) : np.searchsorted(heavy_terms, i + TERMS_AT_ONCE)] - i
        parts.append((r[kept], b[kept], c[kept]))
    value = single[place]
    steps = np.zeros(len(terms), np.int64)
    r, b, c = (np.concatenate(x) for x in zip(*parts))
    taken = np.full(len(terms), -1, np.int64)
    taken[heavy] = np.arange(len(heavy))
    t = np.zeros((len(heavy), SAMPLES), np.float32)
    for i in range(0, len(heavy), 4096):
        own = heavy_place[i : i + 4096]
        weight = np.log(counts[heavy[i : i + 4096]]).astype(np.float32)[:, None]
        t[i : i + 4096] = np.floor(weight / r[own] + b[own])
        value[heavy[i : i + 4096]] = c[own] - r[own] * (t[i : i + 4096] - b[own] + 1)
    least = np.minimum.reduceat(value, begins[:-1][full], axis=0)
    sizes = np.diff(begins)[full]
    pair, sample = np.nonzero(value == np.repeat(least, sizes, axis=0))
    text = np.repeat(np.arange(len(full)), sizes)[pair]
    # Of equal values the first term counts: written last.
    pair, sample, text = pair[::-1], sample[::-1], text[::-1]
    steps = np.where(taken[pair] >= 0, t[taken[pair], sample] if len(heavy) else 0, 0).astype(np.int64)
    found = np.zeros((len(full), SAMPLES), np.uint16)
    found[text, sample] = mixed(terms[pair] * BASE + steps.view(np.uint64)) >> np.uint64(64 - 8 * CODE_BYTES)
    codes[full] = found
    return codes


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal draws, row by row."""
    return (a == b).mean(axis=1)


def written_out(codes: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in codes.astype(">u2")]


def edited(text: str, following: str) -> str:
    """The last half of the characters replaced by as many first ones of the next text, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def neighbours(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, bucket, copied), sorted within partitions so that each row is followed by its neighbour.

    A copied row is only somebody's neighbour. Bounds of the ranges and the first
    id of each are as many as there are ranges; a scan partition has a few.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    tasks = max(1, rows.rdd.getNumPartitions())
    shares = [i / (tasks * RANGES) for i in range(1, tasks * RANGES)]
    bounds = sorted(set(rows.approxQuantile("doc_id", shares, 0.1 / (tasks * RANGES)))) if shares else []
    inner = [float("-inf"), *(bounds or [0.0]), float("inf")]
    rows = rows.withColumn("_number", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))))
    rows = Bucketizer(splits=inner, inputCol="_number", outputCol="bucket").transform(rows).drop("_number")
    # Ids are ordered with NULL first, equal ids by their texts' hashes.
    number = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).alias("number")
    rows = rows.withColumns({"bucket": F.col("bucket").cast("int"), "number": number, "hash": F.xxhash64("text")})
    # One row per range. The first id of a range may be very frequent: its rows are dealt by their hashes.
    lows = F.broadcast(written(rows.groupBy("bucket").agg(F.min("number").alias("low")), "lows"))
    counted = rows.select("bucket", "number").join(lows, "bucket").groupBy("bucket").agg(
        F.min("low").alias("low"), F.count_if(F.col("number") == F.col("low")).alias("repeats"), F.count(F.lit(1)).alias("n")
    )
    counted = written(counted, "counted")
    fair = (counted.agg(F.sum("n")).first()[0] or 0) // (tasks * RANGES) + 1
    parts = F.ceil(F.col("repeats") / F.lit(fair)).cast("int").alias("parts")
    rows = rows.join(F.broadcast(counted.select("bucket", "low", parts)), "bucket")
    share = F.shiftrightunsigned("hash", 1) / F.lit(float(1 << 63))
    # Signed hashes in ascending order: the negative half comes first.
    ordered = F.when(share < 0.5, share + 0.5).otherwise(share - 0.5)
    part = F.when(F.col("number") == F.col("low"), F.floor(ordered * F.col("parts")).cast("int")).otherwise(F.col("parts"))
    rows = rows.withColumn("part", part).drop("low", "parts")
    heads = rows.groupBy("bucket", "part").agg(F.min(F.struct("number", "hash")).alias("head"))
    heads = written(heads, "heads")
    # At most two rows per range and one more per fair share of all rows.
    order = Window.orderBy("bucket", "part")
    last = F.max(F.struct("bucket", "part")).over(Window.partitionBy())
    before = F.coalesce(F.lag(F.struct("bucket", "part")).over(order), last)
    joined = rows.join(F.broadcast(heads.select("bucket", "part", "head", before.alias("before"))), ["bucket", "part"])
    own = F.struct(F.col("bucket"), F.col("part"), F.lit(False).alias("copied"))
    copy = F.struct(F.col("before.bucket").alias("bucket"), F.col("before.part").alias("part"), F.lit(True).alias("copied"))
    places = F.when(F.struct("number", "hash") == F.col("head"), F.array(own, copy)).otherwise(F.array(own))
    dealt = joined.withColumn("_at", F.explode(places))
    dealt = dealt.select("doc_id", "text", (F.col("_at.bucket") * F.lit(1 << 32) + F.col("_at.part")).alias("bucket"), "_at.copied")
    return dealt.repartition(tasks, "bucket").sortWithinPartitions(
        "bucket", "copied", F.col("doc_id").asc_nulls_first(), F.xxhash64("text")
    )


def fingerprint_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness to each other and to the next text."""
    return neighbours(docs, id_col, text_col).mapInArrow(_compare, PAIRS)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            held.append(row)
            size += len(row[1])
            if size >= CHUNK_CHARS and len(held) > 1:
                yield _rows(held)
                held = held[-1:]
                size = len(held[0][1])
    if len(held) > 1:
        yield _rows(held)


def _rows(held: list[tuple]) -> pa.RecordBatch:
    """Rows of all but the last one held, and but for copies, which end a range."""
    at = [i for i, (a, b) in enumerate(zip(held, held[1:])) if a[2] == b[2] and not a[3]]
    texts = [row[1] for row in held]
    changed = [edited(texts[i], texts[i + 1]) for i in at]
    codes = signatures(texts + changed)
    plain, other = codes[: len(texts)], codes[len(texts) :]
    at_ = np.array(at, np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([held[i][0] for i in at], pa.int64()),
            pa.array([len(texts[i]) for i in at], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed], pa.string()),
            pa.array(written_out(plain[at_]), pa.string()),
            pa.array(written_out(other), pa.string()),
            pa.array(likeness(plain[at_], other)),
            pa.array(likeness(plain[at_], plain[at_ + 1])),
        ],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


@query("op3_weighted_fingerprint")
def op3_weighted_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_pairs(table(spark, sf_dir, "documents"))
