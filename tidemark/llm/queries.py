"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import byte_bpe, codes, forest, imatch, language, merkle, near_dup, positional, substring, suffixes, token_counts, toxicity, warc

QUERIES = {
    "op1_token_counts": token_counts.op1_token_counts,
    "op2_language_id": language.op2_language_id,
    "op3_near_duplicates": near_dup.op3_near_duplicates,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_decontamination": positional.op5_decontamination,
    "op6_nearest_neighbours": forest.op6_nearest_neighbours,
    "op7_byte_bpe": byte_bpe.op7_byte_bpe,
    "op8_substring_dedup": substring.op8_substring_dedup,
    "op9_warc": warc.op9_warc,
    "op10_suffix_dedup": suffixes.op10_suffix_dedup,
    "op11_vector_codes": codes.op11_vector_codes,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_document_fingerprints": imatch.op13_document_fingerprints,
}
ORACLES = {
    "op3_near_duplicates": near_dup.ORACLE,
    "op5_decontamination": positional.ORACLE,
    "op8_substring_dedup": substring.ORACLE,
    "op9_warc": warc.ORACLE,
    "op10_suffix_dedup": suffixes.ORACLE,
    "op11_vector_codes": codes.ORACLE,
    "op12_merkle_manifest": merkle.ORACLE,
    "op13_document_fingerprints": imatch.ORACLE,
}
