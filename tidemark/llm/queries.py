"""The queries over the shared tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from tidemark.llm import (
    chat,
    decontamination,
    divergence,
    extraction,
    importance,
    jaccard,
    packing,
    pii,
    quality,
    scoring,
    secrets,
    simhash,
    substrings,
)

QUERIES = {
    "op1_secret_scan": secrets.op1_secret_scan,
    "op2_packing": packing.op2_packing,
    "op3_substring_dedup": substrings.op3_substring_dedup,
    "op4_quality_rules": quality.op4_quality_rules,
    "op5_chat_formatting": chat.op5_chat_formatting,
    "op6_benchmark_decontamination": decontamination.op6_benchmark_decontamination,
    "op7_html_extraction": extraction.op7_html_extraction,
    "op8_ngram_jaccard_join": jaccard.op8_ngram_jaccard_join,
    "op9_pii": pii.op9_pii,
    "op10_lm_scoring": scoring.op10_lm_scoring,
    "op11_simhash_dedup": simhash.op11_simhash_dedup,
    "op12_source_divergence": divergence.op12_source_divergence,
    "op13_importance_resampling": importance.op13_importance_resampling,
}

SQL = {
    "op3_substring_dedup": substrings.OP3_SQL,
    "op5_chat_formatting": chat.OP5_SQL,
    "op6_benchmark_decontamination": decontamination.OP6_SQL,
    "op12_source_divergence": divergence.OP12_SQL,
}
