"""Queries of the training-data operators, by name."""

from __future__ import annotations

from . import exact_dedup, language_id, lm_scoring, mixing, quality_rules, sentencepieces, sharding, simhash, suffix_dedup, token_files

QUERIES = {
    "op1_quality_rules": quality_rules.query,
    "op2_language_id": language_id.query,
    "op3_token_files": token_files.query,
    "op4_lm_scoring": lm_scoring.query,
    "op5_sharding": sharding.query,
    "op6_suffix_dedup": suffix_dedup.query,
    "op7_exact_dedup": exact_dedup.query,
    "op8_mixing": mixing.query,
    "op9_sentencepiece": sentencepieces.query,
    "op10_simhash": simhash.query,
    "sentencepiece_viterbi": sentencepieces.viterbi_query,
}
ORACLES = {"op1_quality_rules": quality_rules.ORACLE, "op6_suffix_dedup": suffix_dedup.ORACLE, "op7_exact_dedup": exact_dedup.ORACLE}
