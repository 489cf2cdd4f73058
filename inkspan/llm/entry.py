"""Queries and SQL of this subpackage, for __spark_entry__.py."""

from __future__ import annotations

import importlib

#: Module by query; the query is a function of that name, its SQL (if any) the module's SQL.
MODULES = {
    "op1_sentencepiece_codec": "sentencepiece_codec",
    "op2_exact_topk": "topk",
    "op3_best_fit_packing": "packing",
    "op4_language_id": "langid",
    "op5_pii": "pii",
    "op6_quality_rules": "quality",
    "op7_line_dedup": "linededup",
    "op8_token_files": "tokens",
    "op9_substring_dedup": "chunkdedup",
    "op10_minhash_near_dedup": "neardup",
    "op11_prefix_trie": "trie",
    "op12_fill_in_middle": "fim",
    "op13_bpe_codec": "bpe",
}


def _modules():
    return {name: importlib.import_module(f"inkspan.llm.{m}") for name, m in MODULES.items()}


def queries() -> dict:
    return {name: getattr(m, name) for name, m in _modules().items()}


def oracle_sql() -> dict[str, str]:
    return {name: m.SQL for name, m in _modules().items() if getattr(m, "SQL", None)}
