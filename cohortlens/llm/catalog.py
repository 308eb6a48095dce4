"""The registered queries of the training-data operators and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from . import chat, exact_dedup, filter_audit, lexical, licences, minhash, mixing, packing, parsing, pii, quality, simhash, toxicity

QUERIES = {
    "op1_toxicity_mil": toxicity.op1_toxicity_mil,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_mix_poisson": mixing.op3_mix_poisson,
    "op4_quality_weak_labels": quality.op4_quality_weak_labels,
    "op5_pii_native": pii.op5_pii_native,
    "op6_rotate_perspectives": chat.op6_rotate_perspectives,
    "op7_simhash_golay": simhash.op7_simhash_golay,
    "op8_pack_documents": packing.op8_pack_documents,
    "op9_licence_scan": licences.op9_licence_scan,
    "op10_parse_fingerprints": parsing.op10_parse_fingerprints,
    "op11_filter_audit": filter_audit.op11_filter_audit,
    "op12_stratified_search": lexical.op12_stratified_search,
    "op13_minhash_stars": minhash.op13_minhash_stars,
}

ORACLES = {
    "op2_exact_dedup": exact_dedup.ORACLE,
    "op3_mix_poisson": mixing.ORACLE,
    "op5_pii_native": pii.ORACLE,
    "op6_rotate_perspectives": chat.ORACLE,
    "op11_filter_audit": filter_audit.ORACLE,
    "op12_stratified_search": lexical.ORACLE,
}
