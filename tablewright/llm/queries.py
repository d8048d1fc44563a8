"""The queries of this subpackage."""

from __future__ import annotations

from tablewright.llm import align, decontaminate, exact_dedup, grammar_ids, near_dup, packing, passages, prefix_trie, sharding, surrogates, token_counts, toxicity, url_rules

MODULES = (sharding, decontaminate, token_counts, passages, surrogates, packing, near_dup, grammar_ids, exact_dedup, toxicity, url_rules, prefix_trie, align)


def all_queries():
    return {k: q for m in MODULES for k, q in m.QUERIES.items()}


def all_sql():
    return {k: s for m in MODULES for k, s in getattr(m, "SQL", {}).items()}
