"""The registered queries of the subpackage and the SQL that gives the same rows, where there is one."""

from __future__ import annotations

from tallyguard.llm import (
    fingerprints, line_dedup, mixing, ngram_join, packing, perspectives, quality, repair, repetition, sanitise,
    spelling, token_counts, toxicity)

QUERIES = {
    "op1_pii_sanitisation": sanitise.op1,
    "op2_line_dedup": line_dedup.op2,
    "op3_toxicity": toxicity.op3,
    "op4_document_fingerprints": fingerprints.op4,
    "op5_chat_perspectives": perspectives.op5,
    "op6_mixing": mixing.op6,
    "op7_quality_rules": repetition.op7,
    "op8_ngram_jaccard_join": ngram_join.op8,
    "op9_quality_classifier": quality.op9,
    "op10_best_fit_packing": packing.op10,
    "op11_conversation_repair": repair.op11,
    "op12_spelling_variants": spelling.op12,
    "op13_token_counts": token_counts.op13,
}
ORACLES = {
    "op5_chat_perspectives": perspectives.ORACLE,
    "op6_mixing": mixing.ORACLE,
    "op8_ngram_jaccard_join": ngram_join.ORACLE,
    "op11_conversation_repair": repair.ORACLE,
    "op12_spelling_variants": spelling.ORACLE,
}
