"""Queries of this subpackage and their DuckDB oracle SQL."""

from __future__ import annotations

from . import ann, chat, collocations, decontaminate, importance, lang_id, mixing, near_dup, pii, substring, token_counts, toxicity, url_filter

QUERIES = {
    "op1_language_id": lang_id.op1_language_id,
    "op2_nearest_neighbours": ann.op2_nearest_neighbours,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_chat_format": chat.op4_chat_format,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_substring_dedup": substring.op6_substring_dedup,
    "op7_pii": pii.op7_pii,
    "op8_url_filter": url_filter.op8_url_filter,
    "op9_mix_sources": mixing.op9_mix_sources,
    "op10_near_dedup": near_dup.op10_near_dedup,
    "op11_collocations": collocations.op11_collocations,
    "op12_toxicity": toxicity.op12_toxicity,
    "op13_importance": importance.op13_importance,
}

ORACLES = {
    "op3_decontaminate": decontaminate.ORACLE,
    "op4_chat_format": chat.ORACLE,
    "op8_url_filter": url_filter.ORACLE,
    "op9_mix_sources": mixing.ORACLE,
    "op10_near_dedup": near_dup.ORACLE,
    "op11_collocations": collocations.ORACLE,
}
