"""Queries of the training-data operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from . import chat, decontaminate, lang_id, packing, simhash, spotsigs, substring, token_counts, token_output, toxicity

QUERIES = {
    "op1_token_counts": token_counts.query,
    "op2_language_id": lang_id.query,
    "op3_simhash_near_dedup": simhash.query,
    "op4_substring_dedup": substring.query,
    "op5_spotsigs": spotsigs.query,
    "op6_decontamination": decontaminate.query,
    "op7_chat_format": chat.query,
    "op8_token_output": token_output.query,
    "op9_toxicity": toxicity.query,
    "op10_packing": packing.query,
}

ORACLES: dict[str, str] = {
    "op4_substring_dedup": substring.ORACLE,
    "op6_decontamination": decontaminate.ORACLE,
    "op7_chat_format": chat.ORACLE,
}
