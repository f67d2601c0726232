"""Documents that hold benchmark items, also with other numbers, names or units in them.

Everything is DataFrame functions. Texts become words, and words become
template tokens: numbers, units of measure and names (a capitalised word inside a sentence)
turn into typed placeholders, all else into lower case without punctuation. Windows of
template tokens of items are joined by hash with those of documents.

A match puts an item's window at some place of a document; matches with the same
distance between both places are one occurrence. In an occurrence every value in
a slot of the item has to stand for one value of the document and the other way
round, else it is another question of the same shape, of which only windows that
match word for word count. A document holds an item if the windows that count cover
at least ``share`` of the item's distinct windows of enough plain words, or if so
many of its words in a row are the same that the share does not matter.

Items without such a window are found as a whole: all their windows in one
occurrence, with equal values, or with values that fit if they have plain words
enough. Items shorter than a window are found word for word.

Defined cases: NULL and empty texts hold nothing and are held by nothing; items
of one or two words are found only in documents that are nothing else; windows with fewer
than ``literals`` plain words do not count for items that have others; repeated
documents repeat their rows once per id; rows with a NULL id are not reported;
empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.registry import query, table
from touchline.operators.skew import bounded_broadcast
from touchline.session import written

WINDOW = 5
# Plain words that a window needs to count, and to tell what stands in its slots.
LITERALS = 4
SLOT_LITERALS = 2
SHARE = 0.5
# Words of an item in a row, the same in the document, that count whatever their share of the item.
RUN = 13
# Items of fewer words are no questions, and are found only as whole documents.
SHORTEST = 3
# Index rows that are broadcast, of some 40 bytes each; a larger index is joined by a shuffle.
BROADCAST_WINDOWS = 500_000

# Marks of names inside texts, placeholders, and units of measure.
NAME_MARK = "\x01"
NAME, NUMBER, UNIT = "<name>", "<num>", "<unit>"
UNITS = (
    "mm cm m km mi mile miles inch inches foot feet ft yard yards mg g kg gram grams lb lbs pound pounds oz ounce ounces ton "
    "tons ml l liter liters litre litres gallon gallons ms s sec second seconds min minute minutes h hr hour hours day days "
    "week weeks month months year years percent dollar dollars cent cents euro euros kmh mph hz khz mhz ghz kb mb gb tb "
    "watt watts kw kwh volt volts degree degrees celsius fahrenheit"
).split()


def words_of(text: str) -> Column:
    """Lower-case words; a name carries a mark, and a number keeps the signs between its digits."""
    value = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"\p{Lu}(?<=[\p{L}\p{N},;] .)\p{Ll}+", f"{NAME_MARK}$0")
    value = F.regexp_replace(value, r"(?:[^\p{L}\p{N}\x01.,:/]|[.,:/](?![0-9])|(?<![0-9])[.,:/])+", " ")
    return F.filter(F.split(F.lower(value), " "), lambda w: w != "")


def template_of(words: Column) -> Column:
    """One template token for every word."""

    def token(word: Column) -> Column:
        first = F.substring(word, 1, 1)
        return (
            F.when(first == NAME_MARK, NAME)
            .when((first >= "0") & (first <= "9"), NUMBER)
            .when(word.isin(UNITS), UNIT)
            .otherwise(word)
        )

    return F.transform(words, token)


def windows(texts: DataFrame, id_col: str, text_col: str, window: int, literals: int = SLOT_LITERALS) -> DataFrame:
    """(id, place, window, values): hashed windows of template tokens, and the words in their slots.

    ``values`` is NULL in windows without a slot. Windows with fewer than ``literals``
    plain words are hashed by their words. Only the id goes with the exploded windows.
    """
    rows = texts.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), words_of(text_col).alias("words"))
    rows = rows.withColumn("template", template_of(F.col("words")))
    rows = rows.withColumn("slots", F.exists("template", lambda t: t.isin(NAME, NUMBER, UNIT)))

    def at(i: Column) -> Column:
        part, words = F.slice("template", i, window), F.slice("words", i, window)
        filled = F.filter(
            F.zip_with(part, words, lambda t, w: F.when(t.isin(NAME, NUMBER, UNIT), w)), lambda w: w.isNotNull()
        )
        values = F.when(F.col("slots"), filled)
        few = F.coalesce(F.size(values), F.lit(0)) > window - literals
        hashed = F.xxhash64(F.when(few, words).otherwise(part))
        return F.struct(i.alias("place"), hashed.alias("window"), values.alias("values"))

    last = F.greatest(F.size("template") - (window - 1), F.lit(1))
    found = F.when(F.size("template") > 0, F.transform(F.sequence(F.lit(1), last), at))
    return rows.select("id", F.explode(found).alias("w")).select(
        "id", "w.place", "w.window", F.when(F.size("w.values") > 0, F.col("w.values")).alias("values")
    )


def short_items(docs: DataFrame, items: DataFrame, window: int, id_col: str, text_col: str, item_col: str, item_text_col: str):
    """(doc_id, item_id) of items of at least three words, but fewer than a window, that a document holds word for word."""
    found = None
    lengths = items.select(F.size(words_of(item_text_col)).alias("n")).where(F.col("n").between(SHORTEST, window - 1))
    for n in sorted(r.n for r in lengths.distinct().collect()):
        short = items.where(F.size(words_of(item_text_col)) == n)
        index = windows(short, item_col, item_text_col, n, n + 1).select(F.col("id").alias("item_id"), "window")
        index = written(index, "short-items")
        held = windows(docs, id_col, text_col, n, n + 1).join(bounded_broadcast(index, BROADCAST_WINDOWS), "window")
        held = held.select(F.col("id").alias("doc_id"), "item_id").distinct()
        found = held if found is None else found.unionByName(held)
    return found


def find_items(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    literals: int = LITERALS,
    share: float = SHARE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, matched, windows, share) of every document that holds an item.

    The index of items is broadcast if it was counted and found small.
    """
    index = windows(items, item_col, item_text_col, window)
    plain = F.lit(window) - F.coalesce(F.size("values"), F.lit(0))
    index = index.select(
        F.col("id").alias("item_id"),
        F.col("place").alias("item_place"),
        "window",
        (plain >= min(literals, SLOT_LITERALS)).alias("tells"),
        F.when(plain >= literals, F.col("window")).alias("counted"),
        F.col("values").alias("item_values"),
        plain.alias("plain"),
    )
    index = written(index, "item-windows")
    totals = written(
        index.groupBy("item_id").agg(
            F.count_distinct("counted").alias("windows"),
            F.count(F.lit(1)).alias("places"),
            F.sum(F.col("plain")).alias("plain_sum"),
        ),
        "items",
    )
    # Items without a window that counts are found as a whole, by all their windows.
    whole = totals.where("windows = 0").select("item_id", F.lit(True).alias("whole"))
    index = index.join(whole, "item_id", "left").where(F.col("tells") | F.col("whole"))
    index = written(index.select("item_id", "item_place", "window", "counted", "item_values"), "index")
    matched = windows(docs, id_col, text_col, window).join(bounded_broadcast(index, BROADCAST_WINDOWS), "window")
    literal = F.col("values").eqNullSafe(F.col("item_values"))
    pairs = F.arrays_zip(F.col("item_values").alias("a"), F.col("values").alias("b"))
    occurrences = matched.groupBy(
        F.col("id").alias("doc_id"), "item_id", (F.col("place") - F.col("item_place")).alias("distance")
    ).agg(
        F.collect_set("counted").alias("found"),
        F.collect_set(F.when(literal, F.col("counted"))).alias("same"),
        F.collect_set("item_place").alias("at"),
        F.array_sort(F.collect_set(F.when(literal, F.col("item_place")))).alias("same_at"),
        F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs"),
    )
    fits = (F.size("pairs") == F.size(F.array_distinct("pairs.a"))) & (F.size("pairs") == F.size(F.array_distinct("pairs.b")))

    def covered(state: Column, place: Column) -> Column:
        begin = F.when(place <= state["last"] + window, state["begin"]).otherwise(place)
        longest = F.greatest(state["longest"], place + window - begin)
        return F.struct(begin.alias("begin"), place.alias("last"), longest.alias("longest"))

    # Words in a row that literal matches cover.
    start = F.struct(F.lit(0).alias("begin"), F.lit(-window - 1).alias("last"), F.lit(0).alias("longest"))
    held = (
        occurrences.select(
            "doc_id",
            "item_id",
            F.when(fits, F.col("found")).otherwise(F.col("same")).alias("found"),
            F.aggregate("same_at", start, covered, lambda state: state["longest"]).alias("run"),
            F.size("same_at").alias("same_places"),
            F.when(fits, F.size("at")).otherwise(0).alias("fitting_places"),
        )
        .groupBy("doc_id", "item_id")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_set("found")))).cast("long").alias("matched"),
            F.max("run").alias("run"),
            F.max("same_places").alias("same_places"),
            F.max("fitting_places").alias("fitting_places"),
        )
        .join(totals, "item_id")
    )
    # The sum counts a plain word once for each of up to ``window`` windows that hold it.
    telling = F.col("plain_sum") >= literals * window
    complete = (F.col("same_places") == F.col("places")) | (telling & (F.col("fitting_places") == F.col("places")))
    by_share = (F.col("windows") > 0) & ((F.col("matched") / F.col("windows") >= share) | (F.col("run") >= RUN))
    held = held.where(((F.col("matched") > 0) & by_share) | ((F.col("windows") == 0) & complete))
    result = held.select(
        "doc_id",
        "item_id",
        F.when(F.col("windows") > 0, F.col("matched")).otherwise(F.col("places")).alias("matched"),
        F.when(F.col("windows") > 0, F.col("windows")).otherwise(F.col("places")).alias("windows"),
    )
    short = short_items(docs, items, window, id_col, text_col, item_col, item_text_col)
    if short is not None:
        one = F.lit(1).cast("long")
        short = short.join(result.select("doc_id", "item_id"), ["doc_id", "item_id"], "left_anti")
        result = result.unionByName(short.withColumn("matched", one).withColumn("windows", one))
    return result.withColumn("share", F.col("matched") / F.col("windows"))


@query("op6_decontamination")
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
