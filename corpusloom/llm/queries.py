"""The registered queries of this subpackage and their DuckDB SQL (none where SQL cannot express the operator)."""

from __future__ import annotations

from corpusloom.llm import (
    bpe,
    chat_format,
    embed_dedup,
    merkle,
    packing,
    pii,
    prefix_trie,
    quality_gam,
    quality_rules,
    simhash,
    suffix_dedup,
    token_counts,
    toxicity,
)

QUERIES = {
    "op1_simhash_near_dedup": simhash.op1_simhash_near_dedup,
    "op2_embedding_near_dedup": embed_dedup.op2_embedding_near_dedup,
    "op3_suffix_array_dedup": suffix_dedup.op3_suffix_array_dedup,
    "op4_chat_formatting": chat_format.op4_chat_formatting,
    "op5_quality_rules": quality_rules.op5_quality_rules,
    "op6_packing": packing.op6_packing,
    "op7_byte_level_bpe": bpe.op7_byte_level_bpe,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_token_counts": token_counts.op9_token_counts,
    "op10_quality_classifier": quality_gam.op10_quality_classifier,
    "op11_pii": pii.op11_pii,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}

ORACLE = {
    "op2_embedding_near_dedup": embed_dedup.OP2_SQL,
    "op3_suffix_array_dedup": suffix_dedup.OP3_SQL,
    "op4_chat_formatting": chat_format.OP4_SQL,
    "op5_quality_rules": quality_rules.OP5_SQL,
    "op12_prefix_trie": prefix_trie.OP12_SQL,
    "op13_merkle_manifest": merkle.OP13_SQL,
}
