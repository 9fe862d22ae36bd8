"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import byte_bpe, embedding_dedup, fingerprints, language_id, license_scan, mixing, ngram_join, sharding, token_counts, token_files, url_filters, vector_codes, whitening

QUERIES = {
    "op1_url_filters": url_filters.op1_url_filters,
    "op2_embedding_dedup": embedding_dedup.op2_embedding_dedup,
    "op3_ngram_join": ngram_join.op3_ngram_join,
    "op4_token_counts": token_counts.op4_token_counts,
    "op5_mix_sources": mixing.op5_mix_sources,
    "op6_sharding": sharding.op6_sharding,
    "op7_token_files": token_files.op7_token_files,
    "op8_byte_bpe": byte_bpe.op8_byte_bpe,
    "op9_fingerprints": fingerprints.op9_fingerprints,
    "op10_language_id": language_id.op10_language_id,
    "op11_license_scan": license_scan.op11_license_scan,
    "op12_vector_codes": vector_codes.op12_vector_codes,
    "op13_whitening": whitening.op13_whitening,
}
ORACLES = {
    "op1_url_filters": url_filters.ORACLE,
    "op2_embedding_dedup": embedding_dedup.ORACLE,
    "op3_ngram_join": ngram_join.ORACLE,
    "op5_mix_sources": mixing.ORACLE,
    "op6_sharding": sharding.ORACLE,
    "op12_vector_codes": vector_codes.ORACLE,
}
