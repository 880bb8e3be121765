"""The operators as queries over the given tables, and SQL where SQL can say the same."""

from __future__ import annotations

from cashweave.llm import brown, conversations, decontaminate, interaction, language, pieces, quality, sharding, simhash, substrings, tokenfiles, toxicity, urls

QUERIES = {
    "op1_brown_lm": brown.op1_brown_lm,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_url_filters": urls.op3_url_filters,
    "op4_quality_rules": quality.op4_quality_rules,
    "op5_simhash": simhash.op5_simhash,
    "op6_sharding": sharding.op6_sharding,
    "op7_decontamination": decontaminate.op7_decontamination,
    "op8_language_id": language.op8_language_id,
    "op9_sentencepiece": pieces.op9_sentencepiece,
    "op10_substring_dedup": substrings.op10_substring_dedup,
    "op11_conversation_repair": conversations.op11_conversation_repair,
    "op12_token_files": tokenfiles.op12_token_files,
    "op13_filter_audit": interaction.op13_filter_audit,
}

ORACLES = {
    "op3_url_filters": urls.OP3_SQL,
    "op10_substring_dedup": substrings.OP10_SQL,
    "op13_filter_audit": interaction.OP13_SQL,
}
