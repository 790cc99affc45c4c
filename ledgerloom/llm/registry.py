"""The queries of this subpackage, by name, and the SQL that must give the same rows."""

from __future__ import annotations

from ledgerloom.llm import byte_bpe, hard_negatives, importance, language_id, near_dedup, packing, quality_rules, sharding, simhash, spot_signatures, suffix_dedup, token_counts, warc

QUERIES = {
    "op1_quality_rules": quality_rules.op1_quality_rules,
    "op2_near_dedup": near_dedup.op2_near_dedup,
    "op3_packing": packing.op3_packing,
    "op4_language_id": language_id.op4_language_id,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_sharding": sharding.op6_sharding,
    "op7_byte_bpe": byte_bpe.op7_byte_bpe,
    "op8_spot_signatures": spot_signatures.op8_spot_signatures,
    "op9_warc": warc.op9_warc,
    "op10_suffix_dedup": suffix_dedup.op10_suffix_dedup,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_simhash": simhash.op12_simhash,
    "op13_importance": importance.op13_importance,
}

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": quality_rules.ORACLE_SQL,
    "op2_near_dedup": near_dedup.ORACLE_SQL,
    "op9_warc": warc.ORACLE_SQL,
    "op10_suffix_dedup": suffix_dedup.ORACLE_SQL,
    "op11_hard_negatives": hard_negatives.ORACLE_SQL,
    "op13_importance": importance.ORACLE_SQL,
}
