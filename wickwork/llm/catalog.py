"""Registry of the corpus queries: name -> function, and name -> the same in DuckDB SQL."""

from __future__ import annotations

from wickwork.llm import chat_format, decontamination, fingerprints, line_dedup, lm_scoring, mixing, near_dedup, pii, prefix_trie, quality_classifier, quality_rules, token_output, whitening

QUERIES = {
    "op2_chat_format": chat_format.query,
    "op2_chat_turns": chat_format.turns_query,
    "op7_lm_scoring": lm_scoring.query,
    "op3_quality_classifier": quality_classifier.query,
    "op5_pii": pii.query,
    "op9_decontamination": decontamination.query,
    "op8_minhash_near_dedup": near_dedup.query,
    "op1_token_output": token_output.query,
    "op4_quality_rules": quality_rules.query,
    "op6_mix_sources": mixing.query,
    "op10_line_dedup": line_dedup.query,
    "op11_fingerprints": fingerprints.query,
    "op12_whitening": whitening.query,
    "op13_prefix_trie": prefix_trie.query,
}
SQL = {
    "op2_chat_format": chat_format.SQL,
    "op2_chat_turns": chat_format.TURNS_SQL,
    "op9_decontamination": decontamination.SQL,
    "op8_minhash_near_dedup": near_dedup.SQL,
    "op4_quality_rules": quality_rules.SQL,
    "op6_mix_sources": mixing.SQL,
    "op10_line_dedup": line_dedup.SQL,
    "op13_prefix_trie": prefix_trie.SQL,
}
