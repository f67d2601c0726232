"""Language of a text by prediction by partial matching over bytes.

Each language has a tree of byte contexts up to ``ORDER`` bytes long with the
counts of the byte that followed. A byte's probability comes from the longest
context that has seen it; every longer context that has not pays its escape,
``d / (n + d)`` with n bytes seen after it, d of them distinct, and a seen byte
gets ``c / (n + d)``. A byte no context has seen costs eight bits after all
escapes. The counts do not change while a text is scored, so the sum over its bytes is the
exact length of its code under a language; the shortest code wins, and the
score is that language's share of all languages' 2 ** -length.

The trees come from a bounded sample of documents per language, counted by
Spark tasks. For scoring, the costs of every context and byte seen in any
language are tabled once per order, so a byte needs one look-up, and further ones
only where the longest context is new.

Defined cases: a NULL text or one without a letter is ``und`` with score 0, as is
every text if nothing was learned; rows without a language teach nothing;
repeated rows each get their prediction; an empty table gives no rows; only id,
text and lang are read, and lang never by the scoring.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.arrow_text import pieces, text_bytes
from touchline.llm.registry import query, table
from touchline.llm.word_hash import BASE
from touchline.session import written

ORDER = 4
# Bound of the training sample: documents per language.
SAMPLE = 900
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
GRAMS = "lang string, size int, gram long, seen long"


def grams_at(data: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` bytes that end at each place, the last byte lowest; places before the first whole one are junk."""
    value = np.zeros(len(data), np.uint64)
    for back in range(size - 1, -1, -1):
        value <<= np.uint64(8)
        value[back:] |= data[: len(data) - back].astype(np.uint64) if back else data.astype(np.uint64)
    return value


def places_in_rows(offsets: np.ndarray) -> np.ndarray:
    """How many bytes of its row precede each byte."""
    return np.arange(offsets[-1]) - np.repeat(offsets[:-1], np.diff(offsets))


def count_grams(sample: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, size, gram, seen) summed over (lang, text); a gram is a context and the byte after it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang in batch.column(0).unique().to_pylist():
                own = batch.filter(pa.compute.equal(batch.column(0), lang))
                for part in pieces(own, "text"):
                    data, offsets = text_bytes(part.column(1))
                    behind = places_in_rows(offsets)
                    for size in range(1, order + 2):
                        gram, seen = np.unique(grams_at(data, size)[behind >= size - 1], return_counts=True)
                        columns = [
                            pa.array([lang] * len(gram), pa.string()),
                            pa.array(np.full(len(gram), size, np.int32)),
                            pa.array(gram.view(np.int64)),
                            pa.array(seen.astype(np.int64)),
                        ]
                        yield pa.RecordBatch.from_arrays(columns, names=["lang", "size", "gram", "seen"])

    counted = sample.select("lang", "text").mapInArrow(count, GRAMS)
    return counted.groupBy("lang", "size", "gram").agg(F.sum("seen").alias("seen"))


class Lookup:
    """Rows by 64-bit key: a table of places by a hash, and a sorted list of the keys whose place was taken."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        self.shift = np.uint64(64 - max(8, int(len(keys) * 8).bit_length()))
        places = self._place(keys)
        self.rows = np.zeros(1 << (64 - int(self.shift)), np.int32)
        self.rows[places] = np.arange(len(keys), dtype=np.int32)
        self.others = np.flatnonzero(self.rows[places] != np.arange(len(keys)))

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys ^ (keys >> np.uint64(23))) * BASE) >> self.shift

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of every key, -1 where there is none."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        row = self.rows[self._place(keys)].astype(np.int64)
        missed = np.flatnonzero(self.keys[row] != keys)
        row[missed] = -1
        if len(self.others) and len(missed):
            other_keys = self.keys[self.others]
            at = np.minimum(np.searchsorted(other_keys, keys[missed]), len(other_keys) - 1)
            row[missed] = np.where(other_keys[at] == keys[missed], self.others[at], -1)
        return row


@dataclass
class ContextTrees:
    """Per size of gram the known grams and their costs in bits, and the known contexts and their escapes."""

    langs: list[str]
    grams: list[np.ndarray]
    costs: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]

    @staticmethod
    def build(langs: list[str], lang: np.ndarray, size: np.ndarray, gram: np.ndarray, seen: np.ndarray) -> ContextTrees:
        """From counts, ``lang`` being places in ``langs``."""
        trees = ContextTrees(langs, [], [], [], [])
        known, cost = np.zeros(1, np.uint64), np.full((1, len(langs)), 8.0)
        for length in range(1, int(size.max(initial=0)) + 1):
            own = size == length
            grams, row = np.unique(gram[own], return_inverse=True)
            count = np.zeros((len(grams), len(langs)))
            count[row, lang[own]] = seen[own]
            context = grams >> np.uint64(8)
            contexts, at = np.unique(context, return_inverse=True)
            total, distinct = np.zeros((len(contexts), len(langs))), np.zeros((len(contexts), len(langs)))
            np.add.at(total, at, count)
            np.add.at(distinct, at, count > 0)
            escape = np.where(total > 0, np.log2(np.maximum(total + distinct, 1) / np.maximum(distinct, 1)), 0.0)
            mask = np.uint64((1 << (8 * (length - 1))) - 1)
            # The same grams without their first byte are known one order below.
            shorter = cost[np.searchsorted(known, grams & mask)] if length > 1 else np.full((len(grams), len(langs)), 8.0)
            seen_cost = np.log2(np.maximum(total + distinct, 1)[at] / np.maximum(count, 1))
            cost = np.where(count > 0, seen_cost, escape[at] + shorter)
            known = grams
            trees.grams.append(grams)
            trees.costs.append(cost)
            trees.contexts.append(contexts)
            trees.escapes.append(escape)
        return trees


class Scorer:
    """Code lengths of texts under all languages."""

    def __init__(self, trees: ContextTrees) -> None:
        self.langs = trees.langs
        self.grams = [Lookup(g) for g in trees.grams]
        self.contexts = [Lookup(c) for c in trees.contexts]
        self.costs = [c.astype(np.float32) for c in trees.costs]
        self.escapes = [e.astype(np.float32) for e in trees.escapes]

    def _bits(self, gram: np.ndarray, size: int) -> np.ndarray:
        """Bits of the last byte of every gram under each language."""
        if not size:
            return np.full((len(gram), len(self.langs)), 8.0, np.float32)
        row = self.grams[size - 1].find(gram)
        bits = self.costs[size - 1][row]
        new = np.flatnonzero(row < 0)
        if len(new):
            context = self.contexts[size - 1].find(gram[new] >> np.uint64(8))
            escape = np.where((context >= 0)[:, None], self.escapes[size - 1][context], np.float32(0))
            mask = np.uint64((1 << (8 * (size - 1))) - 1)
            bits[new] = escape + self._bits(gram[new] & mask, size - 1)
        return bits

    def lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of every row's code, a column per language."""
        largest = len(self.grams)
        behind = places_in_rows(offsets)
        gram = grams_at(data, largest)
        bits = np.empty((len(data), len(self.langs)), np.float32)
        whole = behind >= largest - 1
        bits[whole] = self._bits(gram[whole], largest)
        for size in range(1, largest):
            early = np.flatnonzero(behind == size - 1)
            bits[early] = self._bits(gram[early] & np.uint64((1 << (8 * size)) - 1), size)
        total = np.zeros((len(offsets) - 1, len(self.langs)))
        full = np.flatnonzero(np.diff(offsets))
        if len(full):
            total[full] = np.add.reduceat(bits, offsets[:-1][full], axis=0, dtype=np.float64)
        return total


def learned(id_col: str = "doc_id") -> Column:
    """Rows whose crc32 of the id as text does not leave 1 by 3."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 != 1


def train_language_id(docs: DataFrame, order: int = ORDER, sample: int = SAMPLE) -> ContextTrees:
    """Context trees of all languages in ``docs`` (doc_id, text, lang).

    Of each language the ``sample`` learnable rows with the smallest hashes of
    the id are counted; the driver reads their summed counts.
    """
    rows = docs.where("lang is not null and text is not null and doc_id is not null").where(learned())
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = rows.select("doc_id", "lang").distinct().withColumn("_rank", F.row_number().over(by_hash))
    chosen = written(ids.where(F.col("_rank") <= sample).drop("_rank"), "language-sample")
    langs = sorted(r["lang"] for r in chosen.select("lang").distinct().collect())
    if not langs:
        none = np.zeros(0, np.uint64)
        return ContextTrees.build([], none, none, none, none)
    texts = rows.join(chosen, ["doc_id", "lang"]).select("lang", "text")
    read = count_grams(texts, order).orderBy("lang", "size", "gram").toArrow()
    place = {lang: i for i, lang in enumerate(langs)}
    codes = read["lang"].combine_chunks().dictionary_encode()
    lang = np.array([place[v] for v in codes.dictionary.to_pylist()], np.int64)[codes.indices.to_numpy()]
    gram = read["gram"].to_numpy().view(np.uint64)
    return ContextTrees.build(langs, lang, read["size"].to_numpy(), gram, read["seen"].to_numpy())


@functools.lru_cache(maxsize=1)
def _scorer(shared: Broadcast) -> Scorer:
    return Scorer(shared.value)


def predict_language(docs: DataFrame, trees: ContextTrees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row. The trees are broadcast; the sample bounds their size."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                scorer = _scorer(shared)
                readable = np.array([bool(t and LETTER.search(t)) for t in part.column(1).to_pylist()], bool)
                if scorer.langs:
                    bits = scorer.lengths(*text_bytes(part.column(1)))
                    best = bits.argmin(axis=1)
                    share = 1.0 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000.0)).sum(axis=1)
                else:
                    best, share, readable = np.zeros(len(readable), int), np.zeros(len(readable)), readable & False
                names = [scorer.langs[b] if r else UNKNOWN for b, r in zip(best.tolist(), readable.tolist())]
                columns = [part.column(0), pa.array(names, pa.string()), pa.array(np.where(readable, share, 0.0))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(predict, "doc_id long, lang_pred string, score double")


@query("op10_language_id")
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    predicted = predict_language(docs, train_language_id(docs))
    return predicted.select("doc_id", F.coalesce(~learned(), F.lit(False)).alias("held_out"), "lang_pred", "score")
