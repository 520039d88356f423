"""Queries of this subpackage, and their SQL."""

from __future__ import annotations

from loomlink.llm import bpe, chat, ngram_join, packing, pii, quality_classifier, quality_rules, suffix_dedup, token_counts, topk

_MODULES = [ngram_join, quality_rules, suffix_dedup, packing, pii, token_counts, quality_classifier, chat, topk, bpe]


def queries() -> dict:
    return {k: v for m in _MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: v for m in _MODULES for k, v in m.SQL.items()}
