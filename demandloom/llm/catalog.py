"""The registered queries of the corpus operators and their SQL twins."""

from __future__ import annotations

from demandloom.llm import (
    exact_dedup,
    hard_negatives,
    jaccard_join,
    language,
    line_dedup,
    lm_score,
    merkle,
    mixing,
    packing,
    quality_rules,
    quality_votes,
    token_blocks,
    toxicity,
)

QUERIES = {
    "op1_language_id": language.query,
    "op2_lm_score": lm_score.query,
    "op3_quality_votes": quality_votes.query,
    "op4_best_fit_packing": packing.query,
    "op5_exact_dedup": exact_dedup.query,
    "op6_quality_rules": quality_rules.query,
    "op7_line_dedup": line_dedup.query,
    "op8_token_blocks": token_blocks.query,
    "op9_jaccard_join": jaccard_join.query,
    "op10_source_mixing": mixing.query,
    "op11_hard_negatives": hard_negatives.query,
    "op12_merkle_manifest": merkle.query,
    "op13_toxicity": toxicity.query,
}

ORACLES = {
    "op5_exact_dedup": exact_dedup.ORACLE,
    "op7_line_dedup": line_dedup.ORACLE,
    "op10_source_mixing": mixing.ORACLE,
    "op11_hard_negatives": hard_negatives.ORACLE,
    "op12_merkle_manifest": merkle.ORACLE,
}
