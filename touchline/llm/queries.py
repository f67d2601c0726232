"""All queries of this subpackage; importing the modules registers them."""

from touchline.llm import (
    decontamination,
    language_id,
    lexical_search,
    mixing,
    prefix_trie,
    secret_scan,
    simhash,
    substring_dedup,
    suffix_dedup,
    token_records,
    toxicity,
    url_filter,
    weighted_fingerprint,
)
from touchline.llm.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "decontamination",
    "language_id",
    "lexical_search",
    "mixing",
    "prefix_trie",
    "secret_scan",
    "simhash",
    "substring_dedup",
    "suffix_dedup",
    "token_records",
    "toxicity",
    "url_filter",
    "weighted_fingerprint",
]
