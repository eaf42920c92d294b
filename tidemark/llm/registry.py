"""Queries of the training-data operators and their DuckDB statements."""

from __future__ import annotations

from tidemark.llm import decontam, htmltext, jaccard, langid, licenses, merkle, mixing, pii, quality, sharding, suffixtree, toxicity, whitening

QUERIES = {
    "op1_line_first_quality": quality.q_quality,
    "op2_template_extract": htmltext.q_extract,
    "op3_information_sanitise": pii.q_sanitise,
    "op4_license_scan": licenses.q_licenses,
    "op5_ftrl_toxicity": toxicity.q_toxicity,
    "op6_minhash_jaccard_join": jaccard.q_jaccard,
    "op7_jump_hash_shards": sharding.q_shard,
    "op8_winnow_decontaminate": decontam.q_decontaminate,
    "op9_language_backoff": langid.q_language,
    "op10_mix_sources": mixing.q_mix,
    "op11_suffix_tree_score": suffixtree.q_score,
    "op12_embedding_whitening": whitening.q_whiten,
    "op13_merkle_manifest": merkle.q_merkle,
}

SQL = {
    "op1_line_first_quality": quality.SQL,
    "op7_jump_hash_shards": sharding.SQL,
    "op8_winnow_decontaminate": decontam.SQL,
    "op10_mix_sources": mixing.SQL,
    "op13_merkle_manifest": merkle.SQL,
}
