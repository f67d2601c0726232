"""Toxicity by averaged subword embeddings and a linear softmax, trained jointly in numpy.

A word's vector is the mean of the embeddings of its character n-grams, with the
blanks around it as marks, so a misspelt word shares most of its vectors with the
right one. Words repeated in a row count once. A passage is some consecutive
words; the mean of its word vectors goes through a linear softmax over (clean,
toxic). A document's score is the probability of its most toxic passage, so a
long document is not excused by its length. n-grams are hashed to a fixed number
of embeddings.

Training takes a bounded sample of labelled rows, the same one each time, whose
classes are weighted back to their counts. The first round averages long
passages at random places; later rounds use the most toxic passage of each
document under the model so far, and a random passage of each clean one. Only
the n-grams of distinct words are held. The trained pair of
matrices collapses to one number per n-gram for scoring.

Defined cases: a NULL or blank text has no passage and the score of the bias
alone; without labels of both classes every score is the learned share of toxic
rows, 0 if there are none; several labels of an id count as toxic if one is;
repeated rows each get their score; an empty table gives no rows; other columns
pass through ``score_toxicity`` unread.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from touchline.llm.arrow_text import pieces
from touchline.llm.registry import query, table

SIZES = (3, 4, 5)
BUCKET_BITS = 17
DIMENSIONS = 8
PASSAGE = 8
FIRST_PASSAGE = 128
ROUNDS = 8
BATCH = 64
RATE = 0.05
# Averages are multiplied by this before the softmax, so that embeddings stay small.
SHARPNESS = 20.0
# Bounds of the training sample.
TOXIC_ROWS = 1500
CLEAN_ROWS = 3000
SCORED_BYTES = 1 << 19
WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Distinct words whose n-grams are cut at a time in training.
WORDS_AT_ONCE = 20_000
HASH = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)]


@dataclass
class Words:
    """The bucket and the word of every n-gram of some texts, and the first word of every text."""

    buckets: np.ndarray
    owners: np.ndarray
    first: np.ndarray


def _words(texts: Sequence[str], sizes: Sequence[int] = SIZES, bits: int = BUCKET_BITS) -> Words:
    lowered = [text.lower() for text in texts]
    codes = np.frombuffer((" " + "  ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    # Every text has a blank before and after it.
    begins = np.cumsum([0] + [len(text) + 2 for text in lowered])
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
    codes = np.where(blank, 32, codes).astype(np.uint64)
    starts = np.flatnonzero(~blank & np.r_[True, blank[:-1]])
    ends = np.flatnonzero(blank & np.r_[False, ~blank[:-1]])
    first = np.searchsorted(starts, begins)
    before = np.concatenate([[0], np.cumsum(blank)])
    mark = np.zeros(len(codes), np.int64)
    mark[starts] = 1
    word = np.cumsum(mark) - 1
    kept = ~_repeats(codes, starts, ends, first)
    buckets, owners = [], []
    for size in sizes:
        if len(codes) < size:
            continue
        at = np.arange(len(codes) - size + 1)
        # No blank inside: the first and the last character may be one.
        at = at[before[at + size - 1] == before[at + 1]]
        value = np.zeros(len(at), np.uint64)
        for i in range(size):
            value = value * HASH[0] + codes[at + i] + np.uint64(1)
        value = (value ^ (value >> np.uint64(29))) * HASH[1]
        buckets.append((value >> np.uint64(64 - bits)).astype(np.int32))
        owners.append(word[at + 1])
    owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    bucket = np.concatenate(buckets) if buckets else np.zeros(0, np.int32)
    # Renumber the words that stay.
    number = np.cumsum(kept) - 1
    stays = kept[owner]
    return Words(bucket[stays], number[owner[stays]], np.concatenate([[0], np.cumsum(kept)])[first])


def _repeats(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Words that are the same as the word before them in their text."""
    powers = np.cumprod(np.full(len(codes), HASH[0], np.uint64))
    inverse = np.cumprod(np.full(len(codes), np.uint64(pow(int(HASH[0]), -1, 1 << 64)), np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * HASH[1] * powers)])
    value = (sums[ends] - sums[starts]) * inverse[starts]
    same = np.zeros(len(starts), bool)
    same[1:] = (value[1:] == value[:-1]) & ((ends - starts)[1:] == (ends - starts)[:-1])
    same[first[first < len(starts)]] = False
    return same


def best_passages(word: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every text the highest mean word score of a passage, its first word and its number of words.

    A text shorter than a passage is one; a text without words has score 0.
    """
    total = len(word)
    sums = np.concatenate([[0.0], np.cumsum(word)])
    sizes = np.diff(first)
    lengths = np.minimum(sizes, length)
    text = np.repeat(np.arange(len(sizes)), sizes)
    whole = np.flatnonzero(np.arange(total) + length <= first[text + 1]) if total else np.zeros(0, np.int64)
    value = np.full(total, -np.inf)
    value[whole] = (sums[whole + length] - sums[whole]) / length
    short = np.flatnonzero((sizes > 0) & (sizes < length))
    value[first[short]] = (sums[first[short + 1]] - sums[first[short]]) / sizes[short]
    best, place = np.zeros(len(sizes)), first[:-1].copy()
    full = np.flatnonzero(sizes)
    if len(full):
        best[full] = np.maximum.reduceat(value, first[:-1][full])
        at = np.flatnonzero(value == best[text])
        texts, earliest = np.unique(text[at], return_index=True)
        place[texts] = at[earliest]
    return best, place, lengths


@dataclass
class ToxicityModel:
    """One number per n-gram bucket, added up to the log odds of toxic, and the bias."""

    numbers: np.ndarray
    bias: float

    def score(self, texts: Sequence[str]) -> np.ndarray:
        words = _words(texts)
        counts = np.bincount(words.owners, minlength=int(words.first[-1]))
        mean = np.bincount(words.owners, self.numbers[words.buckets], len(counts)) / np.maximum(counts, 1)
        best, _, _ = best_passages(mean, words.first, PASSAGE)
        return 1.0 / (1.0 + np.exp(-np.clip(best + self.bias, -500, 500)))


def _distinct(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers of all texts, the first word of each text, the buckets of each distinct word, and its first bucket."""
    numbers: dict[str, int] = {}
    parts = []
    for text in texts:
        own = np.array([numbers.setdefault(w, len(numbers)) for w in WORD.findall(text.lower())], np.int32)
        parts.append(own[np.r_[True, own[1:] != own[:-1]]] if len(own) else own)
    first = np.cumsum([0] + [len(own) for own in parts])
    known = list(numbers)
    del numbers
    buckets, counts = [], []
    for i in range(0, len(known), WORDS_AT_ONCE):
        cut = _words([" ".join(known[i : i + WORDS_AT_ONCE])])
        buckets.append(cut.buckets[np.argsort(cut.owners, kind="stable")])
        counts.append(np.bincount(cut.owners, minlength=int(cut.first[-1])))
    return np.concatenate(parts), first, np.concatenate(buckets), np.concatenate([[0], np.cumsum(np.concatenate(counts))])


def _word_means(numbers: np.ndarray, buckets: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Mean number of the n-grams of each distinct word, some words at a time."""
    means = []
    for i in range(0, len(grams) - 1, WORDS_AT_ONCE):
        at = grams[i : i + WORDS_AT_ONCE + 1]
        means.append(np.add.reduceat(numbers[buckets[at[0] : at[-1]]], at[:-1] - at[0]) / np.diff(at))
    return np.concatenate(means)


def fit(texts: Sequence[str], toxic: np.ndarray, weights: np.ndarray, seed: int = 0) -> ToxicityModel:
    """Embeddings and softmax weights by stochastic gradients with a step size per number."""
    if not len(texts) or toxic.min() == toxic.max():
        share = float(np.average(toxic, weights=weights)) if len(texts) else 0.0
        odds = 500.0 if share >= 1 else -500.0
        return ToxicityModel(np.zeros(1 << BUCKET_BITS), odds)
    words, first, buckets, grams = _distinct(texts)
    counts = np.diff(grams)
    sizes = np.diff(first)

    rng = np.random.default_rng(seed)
    embeddings = rng.normal(0, 0.1, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32)
    softmax = np.empty((DIMENSIONS, 2), np.float32)
    softmax[:, 1] = rng.normal(0, 0.5, DIMENSIONS)
    softmax[:, 0] = -softmax[:, 1]
    share = float(np.average(toxic, weights=weights))
    bias = np.array([0.0, np.log(share / (1 - share))], np.float32)
    seen = [np.zeros_like(x) for x in (embeddings, softmax, bias)]

    def descend(value: np.ndarray, at, gradient: np.ndarray, squares: np.ndarray) -> None:
        squares[at] += gradient * gradient
        value[at] -= RATE * gradient / np.sqrt(squares[at] + 1e-8)

    has_words = np.flatnonzero(sizes)
    for turn in range(ROUNDS):
        if turn == 0:
            length = np.minimum(sizes, FIRST_PASSAGE)[has_words]
            place = first[:-1][has_words] + rng.integers(0, sizes[has_words] - length + 1)
            label, weight = toxic[has_words], weights[has_words]
        else:
            numbers = (embeddings @ (softmax[:, 1] - softmax[:, 0])).astype(np.float64)
            _, best, lengths = best_passages(_word_means(numbers, buckets, grams)[words], first, PASSAGE)
            clean = has_words[toxic[has_words] == 0]
            other = first[:-1][clean] + rng.integers(0, sizes[clean] - lengths[clean] + 1)
            place = np.concatenate([best[has_words], other])
            length = np.concatenate([lengths[has_words], lengths[clean]])
            label = np.concatenate([toxic[has_words], toxic[clean]])
            weight = np.concatenate([weights[has_words], weights[clean] / 2])
        shuffled = rng.permutation(len(place))
        for i in range(0, len(shuffled), BATCH):
            some = shuffled[i : i + BATCH]
            a, n, y, w = place[some], length[some], label[some], weight[some]
            word = words[np.repeat(a - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
            per_word = counts[word]
            per_text = np.add.reduceat(per_word, np.cumsum(n) - n)
            begins = np.cumsum(per_word) - per_word
            bucket = buckets[np.repeat(grams[word] - begins, per_word) + np.arange(int(per_word.sum()))]
            part = np.repeat((SHARPNESS / per_word / np.repeat(n, n)).astype(np.float32), per_word)
            mean = np.add.reduceat(embeddings[bucket] * part[:, None], np.cumsum(per_text) - per_text, axis=0)
            logits = mean @ softmax + bias
            odds = np.exp(logits - logits.max(axis=1, keepdims=True))
            odds /= odds.sum(axis=1, keepdims=True)
            odds[np.arange(len(some)), y] -= 1
            wrong = (odds * (w[:, None] / len(some))).astype(np.float32)
            back = np.repeat(wrong @ softmax.T, per_text, axis=0) * part[:, None]
            distinct, where = np.unique(bucket, return_inverse=True)
            slope = np.stack([np.bincount(where, back[:, k], len(distinct)) for k in range(DIMENSIONS)], axis=1)
            descend(embeddings, distinct, slope.astype(np.float32), seen[0])
            descend(softmax, slice(None), mean.T @ wrong, seen[1])
            descend(bias, slice(None), wrong.sum(axis=0), seen[2])
    numbers = (embeddings @ (softmax[:, 1] - softmax[:, 0])).astype(np.float64) * SHARPNESS
    return ToxicityModel(numbers, float(bias[1] - bias[0]))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose crc32 of the id as text leaves no rest by 5; their labels are never learned."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train_toxicity(
    docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS
) -> ToxicityModel:
    """A model from at most ``toxic_rows`` and ``clean_rows`` labelled rows outside the held-out part.

    The sample, those with the smallest hashes of the id, is read by one task, which the two arguments bound;
    the driver gets the model alone.
    """
    known = labels.where("toxic is not null and doc_id is not null").where(~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    totals = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    chosen = None
    for value, rows in ((1, toxic_rows), (0, clean_rows)):
        part = known.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        chosen = part if chosen is None else chosen.unionByName(part)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = sample.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, toxic = [], []
        for batch in batches:
            texts += batch.column(1).fill_null("").to_pylist()
            toxic += batch.column(2).to_pylist()
        toxic = np.array(toxic, np.int64)
        weights = np.array([totals.get(v, 0) / max(1, int((toxic == v).sum())) for v in (0, 1)])[toxic]
        model = fit(texts, toxic, weights / weights.mean() if len(weights) else weights)
        columns = [pa.array([model.numbers.tobytes()], pa.binary()), pa.array([model.bias], pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, names=["numbers", "bias"])

    one_task = sample.select("doc_id", "text", "toxic").repartition(1).sortWithinPartitions("doc_id")
    found = one_task.mapInArrow(learn, "numbers binary, bias double").collect()
    if not found:
        return fit([], np.zeros(0, np.int64), np.zeros(0))
    return ToxicityModel(np.frombuffer(found[0]["numbers"]), found[0]["bias"])


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text; the model is one broadcast of a fixed size."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*docs.schema.fields, StructField(score_col, DoubleType())])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text_col, SCORED_BYTES):
                texts = part.column(part.schema.get_field_index(text_col)).fill_null("").to_pylist()
                score = pa.array(shared.value.score(texts))
                yield pa.RecordBatch.from_arrays([*part.columns, score], names=[*part.schema.names, score_col])

    return docs.mapInArrow(compute, schema)


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs, model)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )
