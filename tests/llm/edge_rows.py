"""Small tables with the rows every operator has to stand: NULLs, empty and long texts, ties, repeats, more columns."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, text_hash string, score double, value long"

LONG = " ".join(f"word{i % 977}" for i in range(20_000))

ROWS = [
    (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43, "x", 0.1, 7),
    (2, "the quick brown fox jumps over the lazy dog", "en", "a", 43, "x", 0.1, 7),
    (2, "the quick brown fox jumps over the lazy dog", "en", "a", 43, "x", 0.1, 7),
    (3, None, None, None, None, None, None, None),
    (4, "", "de", "b", 0, "y", 0.2, 8),
    (5, " \n\t ", "de", "b", 4, "y", 0.2, 8),
    (6, LONG, "en", "a", len(LONG), "z", 0.3, 9),
    (7, "12345 !!! ???", None, "b", 13, "z", 0.3, 9),
    (8, "ein Satz über schöne Bücher \U0001f600 und Straßen", "de", "b", 40, "z", None, 9),
    (None, "a row without an id", "en", None, 19, "z", 0.4, 1),
]


def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def texts(spark, values):
    """(doc_id, text) numbered from 0."""
    return spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")
