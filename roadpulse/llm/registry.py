"""The queries of this package over the test tables, and their SQL counterparts."""

from __future__ import annotations

from roadpulse.llm import (
    best_fit_packing,
    chat_tools,
    lexical_search,
    license_scans,
    line_dedup,
    mixing,
    near_dedup,
    phrase_mining,
    projection_forest,
    quality_classifier,
    quality_rules,
    sentence_pieces,
    toxicity,
)


def queries() -> dict:
    return {
        "op1_line_dedup": line_dedup.op1_line_dedup,
        "op2_license_scans": license_scans.op2_license_scans,
        "op3_toxicity": toxicity.op3_toxicity,
        "op4_projection_forest": projection_forest.op4_projection_forest,
        "op5_near_dedup": near_dedup.op5_near_dedup,
        "op6_quality_rules": quality_rules.op6_quality_rules,
        "op7_sentence_pieces": sentence_pieces.op7_sentence_pieces,
        "op8_chat_tools": chat_tools.op8_chat_tools,
        "op9_mixing": mixing.op9_mixing,
        "op10_quality_classifier": quality_classifier.op10_quality_classifier,
        "op11_phrase_mining": phrase_mining.op11_phrase_mining,
        "op12_lexical_search": lexical_search.op12_lexical_search,
        "op13_best_fit_packing": best_fit_packing.op13_best_fit_packing,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": line_dedup.SQL,
        "op2_license_scans": license_scans.SQL,
        "op6_quality_rules": quality_rules.SQL,
        "op8_chat_tools": chat_tools.SQL,
        "op9_mixing": mixing.SQL,
        "op11_phrase_mining": phrase_mining.SQL,
        "op12_lexical_search": lexical_search.SQL,
    }
