"""Queries and statements of this subpackage, by registered name."""

from __future__ import annotations

from occrisk.llm import op1_license, op2_lm, op3_quality, op4_tokens, op5_suffix, op6_html, op7_jaccard, op8_packing, op9_chat, op10_decontamination, op11_counts, op12_negatives, op13_merkle
from occrisk.llm.sql import SQL

__all__ = ["QUERIES", "SQL"]

QUERIES = {
    "op1_license_scan": op1_license.query,
    "op2_language_model": op2_lm.query,
    "op3_quality_rules": op3_quality.query,
    "op4_token_output": op4_tokens.query,
    "op5_suffix_array_dedup": op5_suffix.query,
    "op6_html_extraction": op6_html.query,
    "op7_ngram_jaccard_join": op7_jaccard.query,
    "op8_best_fit_packing": op8_packing.query,
    "op9_chat_formatting": op9_chat.query,
    "op10_decontamination": op10_decontamination.query,
    "op11_token_counts": op11_counts.query,
    "op12_hard_negatives": op12_negatives.query,
    "op13_merkle_manifest": op13_merkle.query,
}
