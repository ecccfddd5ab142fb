"""Operators of a training-data pipeline. Nothing else in the package imports this part."""

from . import (
    byte_bpe,
    conversation_repair,
    exact_dedup,
    jaccard_join,
    lexicon_bpe,
    license_scan,
    packing,
    quality_rules,
    quote_links,
    secret_scan,
    token_count,
    top_k,
    word_runs,
)

_MODULES = (
    exact_dedup,
    quality_rules,
    packing,
    byte_bpe,
    top_k,
    license_scan,
    quote_links,
    token_count,
    secret_scan,
    jaccard_join,
    lexicon_bpe,
    conversation_repair,
    word_runs,
)

QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}

__all__ = ["ORACLES", "QUERIES"]
