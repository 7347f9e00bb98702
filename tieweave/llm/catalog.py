"""The queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from tieweave.llm import (
    alignment,
    decontaminate,
    mixing,
    packing,
    quality,
    relative_parsing,
    secrets,
    simhash_prints,
    simhash_trie,
    spelling,
    suffix_repeats,
    token_counts,
    toxicity,
)

QUERIES = {
    "op1_suffix_array_dedup": suffix_repeats.op1_suffix_array_dedup,
    "op2_document_fingerprints": simhash_prints.op2_document_fingerprints,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op4_quality_classifier": quality.op4_quality_classifier,
    "op5_simhash_near_dedup": simhash_trie.op5_simhash_near_dedup,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_decontamination": decontaminate.op7_decontamination,
    "op8_secret_scans": secrets.op8_secret_scans,
    "op9_token_counts": token_counts.op9_token_counts,
    "op10_substring_dedup": relative_parsing.op10_substring_dedup,
    "op11_source_mixing": mixing.op11_source_mixing,
    "op12_token_alignment": alignment.op12_token_alignment,
    "op13_spelling_variants": spelling.op13_spelling_variants,
}
ORACLES: dict[str, str] = {
    "op1_suffix_array_dedup": suffix_repeats.OP1_SQL,
    "op7_decontamination": decontaminate.OP7_SQL,
    "op10_substring_dedup": relative_parsing.OP10_SQL,
}
