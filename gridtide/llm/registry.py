"""The registered queries of this subpackage and their SQL checks."""

from __future__ import annotations

from gridtide.llm import (
    queries_dedup,
    queries_manifest,
    queries_packing,
    queries_repeats,
    queries_scoring,
)

LLM_QUERIES = {
    "op1_lm_scoring": queries_scoring.op1_lm_scoring,
    "op2_suffix_array_dedup": queries_repeats.op2_suffix_array_dedup,
    "op3_substring_dedup": queries_repeats.op3_substring_dedup,
    "op4_minhash_near_dedup": queries_dedup.op4_minhash_near_dedup,
    "op5_url_filter": queries_scoring.op5_url_filter,
    "op6_benchmark_decontamination": queries_dedup.op6_benchmark_decontamination,
    "op7_quality_rules": queries_dedup.op7_quality_rules,
    "op8_quality_classifier": queries_scoring.op8_quality_classifier,
    "op9_best_fit_packing": queries_packing.op9_best_fit_packing,
    "op10_html_extraction": queries_scoring.op10_html_extraction,
    "op11_cross_tokenizer_alignment": queries_manifest.op11_cross_tokenizer_alignment,
    "op12_curve_packing": queries_manifest.op12_curve_packing,
    "op13_merkle_manifest": queries_manifest.op13_merkle_manifest,
}
#: the others are tested against brute force, held-out accuracy or an exact round trip
LLM_ORACLE: dict[str, str] = {
    "op5_url_filter": queries_scoring.OP5_SQL,
    "op11_cross_tokenizer_alignment": queries_manifest.op11_cross_tokenizer_alignment,
    "op12_curve_packing": queries_manifest.op12_curve_packing,
    "op13_merkle_manifest": queries_manifest.OP13_SQL,
}
