"""Queries and SQL checks of the numbered operators."""

from __future__ import annotations

from riskweave.llm import (
    chat_format,
    divergence,
    exact_dedup,
    lexical_search,
    line_dedup,
    mixing,
    near_dedup,
    quality,
    secret_scan,
    sentence_pieces,
    suffix_dedup,
    token_counts,
    topk_search,
)

MODULES = (
    quality, suffix_dedup, exact_dedup, chat_format, sentence_pieces, token_counts, line_dedup,
    mixing, near_dedup, topk_search, secret_scan, lexical_search, divergence,
)


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
