"""Queries of this subpackage and the SQL they are compared with, where SQL can express them."""

from __future__ import annotations

from corpusloom.llm import bpe, fingerprints, media, mixing, near_dedup, quality, sharding, substring_dedup, token_counts, url_filter

QUERIES = {
    "op1_token_counts": token_counts.op1,
    "op2_url_filter": url_filter.op2,
    "op3_media_chunks": media.op3,
    "op4_source_mixing": mixing.op4,
    "op5_substring_dedup": substring_dedup.op5,
    "op6_near_dedup": near_dedup.op6,
    "op7_fingerprints": fingerprints.op7,
    "op8_quality_classifier": quality.op8,
    "op9_bpe_codec": bpe.op9,
    "op10_sharding": sharding.op10,
}

ORACLES = {
    "op2_url_filter": url_filter.OP2_SQL,
    "op4_source_mixing": mixing.OP4_SQL,
    "op10_sharding": sharding.OP10_SQL,
}
