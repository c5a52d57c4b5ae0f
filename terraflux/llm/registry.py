"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from terraflux.llm import chat_format, decontamination, exact_dedup, html_text, merkle, mixing, near_dedup, pii, quality, quality_rules, substring_dedup, url_filter, whitening

QUERIES = {
    "op1_chat_format": chat_format.op1_chat_format,
    "op2_pii": pii.op2_pii,
    "op3_near_dedup": near_dedup.op3_near_dedup,
    "op4_url_filter": url_filter.op4_url_filter,
    "op5_html_text": html_text.op5_html_text,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_mixing": mixing.op7_mixing,
    "op8_quality": quality.op8_quality,
    "op9_substring_dedup": substring_dedup.op9_substring_dedup,
    "op10_decontamination": decontamination.op10_decontamination,
    "op11_whitening": whitening.op11_whitening,
    "op12_merkle": merkle.op12_merkle,
    "op13_quality_rules": quality_rules.op13_quality_rules,
}

ORACLE_SQL = {
    "op1_chat_format": chat_format.OP1_SQL,
    "op3_near_dedup": near_dedup.OP3_SQL,
    "op4_url_filter": url_filter.OP4_SQL,
    "op6_exact_dedup": exact_dedup.OP6_SQL,
    "op7_mixing": mixing.OP7_SQL,
    "op9_substring_dedup": substring_dedup.OP9_SQL,
    "op10_decontamination": decontamination.OP10_SQL,
    "op12_merkle": merkle.OP12_SQL,
    "op13_quality_rules": quality_rules.OP13_SQL,
}
