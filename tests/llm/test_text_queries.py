"""Queries with SQL against it, and every query's columns."""

import pytest
from oracle import compare, oracle_rows

from touchline.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    1: ["doc_id", "fingerprint", "component_id"],
    2: ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    3: ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    4: ["doc_id", "held_out", "score", "predicted"],
    5: ["doc_id", "start", "n_tokens", "ids_crc32"],
    6: ["doc_id", "item_id"],
    7: ["doc_id", "n_words", "n_removed", "kept_sha256"],
    8: ["page_id", "host", "path", "rule", "verdict"],
    9: ["doc_id", "probability", "kept"],
    10: ["doc_id", "held_out", "lang_pred", "score"],
    11: ["item_id", "rank", "doc_id", "score"],
    12: ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    13: [
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        "ends_sha256",
    ],
}


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == sorted(COLUMNS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns(spark, name):
    columns = QUERIES[name](spark, SF).columns
    assert columns[: len(COLUMNS[int(name[2:].split("_")[0])])] == COLUMNS[int(name[2:].split("_")[0])] or set(
        COLUMNS[int(name[2:].split("_")[0])]
    ) <= set(columns)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(spark, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    assert rows and not compare(df.columns, rows, *oracle_rows(ORACLES[name], SF))
