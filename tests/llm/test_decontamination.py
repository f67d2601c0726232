"""Decontamination against a plain search, re-parameterised items, and slots that do not fit."""

import re

from edge_rows import docs, no_docs, texts
from pyspark.sql import functions as F

from touchline.llm.decontamination import find_items, template_of, words_of
from touchline.llm.queries import QUERIES

ITEM = "A shopkeeper sells 12 apples to Maria for 5 dollars each while Maria owns 30 coins, so how many coins remain for Maria now?"


def items(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "item_id long, text string")


def found(spark, documents, benchmark, **options):
    rows = find_items(texts(spark, documents), items(spark, benchmark), **options).collect()
    return {(r.doc_id, r.item_id) for r in rows}


def test_template_tokens(spark):
    text = "Yesterday in the town of Lyon, 1,200 people ran 3.5 km; so anna won. THE END 7th 2nd"
    row = texts(spark, [text]).select(words_of("text").alias("w")).select(template_of(F.col("w")).alias("t")).first()
    assert row.t == "yesterday in the town of <name> <num> people ran <num> <unit> so anna won the end <num> <num>".split()


def test_other_numbers_names_and_units_are_found(spark):
    other = ITEM.replace("12", "17").replace("Maria", "Tomas").replace("5", "8").replace("dollars", "euros").replace("30", "99")
    mixed = other.replace("for Tomas now", "for Berta now").replace("to Tomas for", "to Clara for")
    shouted = "Some text before. " + ITEM.upper() + " And text after."
    documents = [ITEM, "Well. " + other, mixed, shouted, "nothing of the kind here, just words and more words", ITEM[:45]]
    assert found(spark, documents, [ITEM]) >= {(0, 0), (1, 0)}
    assert not {2, 4, 5} & {i for i, _ in found(spark, documents, [ITEM])}


SHORT = ["What is 12 + 5?", "Compute 17 * 23 - 4 / 2", "Who wrote Hamlet?", "In 1912 Robert Scott reached 90 degrees South."]


def test_items_without_plain_windows_are_found_as_a_whole(spark):
    documents = [f"Some words before that. {item} And words after." for item in SHORT]
    documents += ["What is 13 + 5? Who wrote Macbeth? In 1912 Robert Scott reached 80 degrees South. Compute 17 * 23 - 4 / 3"]
    documents += SHORT
    assert found(spark, documents, SHORT) == {(i, i) for i in range(4)} | {(5 + i, i) for i in range(4)}


def test_one_conflicting_value_leaves_what_matches_word_for_word(spark):
    again = ITEM.replace("Maria now", "Maria with 5 coins now, and how many dollars does each shopkeeper of the town own")
    other = again.replace("with 5 coins", "with 6 coins")
    assert found(spark, [other, "Well, " + other], [again]) == {(0, 0), (1, 0)}


def test_a_long_quotation_counts_whatever_its_share(spark):
    words = [f"{chr(97 + i % 26)}{chr(97 + i // 26)}word" for i in range(60)]
    documents = [" ".join(["before", *words[20:20 + n], "after"]) for n in (12, 13, 25)]
    assert found(spark, documents, [" ".join(words)]) == {(1, 0), (2, 0)}


def test_query_agrees_with_a_plain_search(spark):
    folder = "/root/testdata/sf0.01"
    plain = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    documents = {r.doc_id: plain(r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    benchmark = {r.item_id: plain(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    held = {(i, k) for i, text in documents.items() for k, item in benchmark.items() if item in text}
    rows = QUERIES["op6_decontamination"](spark, folder).collect()
    assert len(held) > 10 and {(r.doc_id, r.item_id) for r in rows} == held
    assert len(rows) == len(held)


def test_windows_are_counted_once(spark):
    twice = ITEM + " " + ITEM
    row = find_items(texts(spark, [twice]), items(spark, [ITEM])).first()
    assert row.matched == row.windows and row.share == 1.0


def test_edge_rows(spark):
    benchmark = items(spark, ["the quick brown fox jumps over the lazy dog", None, "", "word1 word2"])
    rows = find_items(docs(spark), benchmark).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(1, 0), (2, 0)]
    assert find_items(no_docs(spark), benchmark).collect() == []
    assert find_items(docs(spark), items(spark, ["x"]).where("item_id < 0")).collect() == []


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op6_decontamination"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
