"""Registered queries of the training-data operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline

from . import bpe, chat, jaccard, llr, mixing, neighbours, pii, runs, suffix, tokenfile, topk, toxicity, trie

QUERIES = {
    "op1_chat_formatting": chat,
    "op2_likelihood_rules": llr,
    "op3_toxicity_trees": toxicity,
    "op4_neighbour_quality": neighbours,
    "op5_byte_pairs": bpe,
    "op6_source_mix": mixing,
    "op7_jaccard_join": jaccard,
    "op8_threshold_top_k": topk,
    "op9_suffix_dedup": suffix,
    "op10_surrogates": pii,
    "op11_periodic_runs": runs,
    "op12_prefix_trie": trie,
    "op13_token_files": tokenfile,
}


def queries():
    return {name: module.query for name, module in QUERIES.items()} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    found = {name: module.SQL for name, module in QUERIES.items() if getattr(module, "SQL", None)}
    return found | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
