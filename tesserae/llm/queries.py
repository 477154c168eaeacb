"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from tesserae.llm import alignment, bpe, exact, lm, negatives, packing, pii, quality, rules, simhash, substring, tokens, toxicity

QUERIES = {
    "op1_token_counts": tokens.op1_token_counts,
    "op2_packing": packing.op2_packing,
    "op3_exact_dedup": exact.op3_exact_dedup,
    "op4_bpe": bpe.op4_bpe,
    "op5_simhash": simhash.op5_simhash,
    "op6_lm_score": lm.op6_lm_score,
    "op7_quality": quality.op7_quality,
    "op8_quality_rules": rules.op8_quality_rules,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_pii": pii.op10_pii,
    "op11_alignment": alignment.op11_alignment,
    "op12_substring_dedup": substring.op12_substring_dedup,
    "op13_hard_negatives": negatives.op13_hard_negatives,
}
ORACLE_SQL = {"op3_exact_dedup": exact.OP3_SQL, "op8_quality_rules": rules.OP8_SQL, "op12_substring_dedup": substring.OP12_SQL, "op13_hard_negatives": negatives.OP13_SQL}
