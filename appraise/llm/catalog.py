"""Registered queries of the training-data operators and their SQL forms."""

from __future__ import annotations

from appraise.llm import (conversation_repair, doubling_dedup, exact_dedup, language_model, mixing,
                          neighbours, packing, personal_data, quality, simhash,
                          suffix_dedup, token_alignment, url_filter)

QUERIES = {f.__name__: f for f in (
    packing.op1_hilbert_packing,
    personal_data.op2_bilstm_crf_pii,
    suffix_dedup.op3_suffix_merge_dedup,
    language_model.op4_gru_class_lm,
    quality.op5_quality_cascade,
    mixing.op6_flow_mixing,
    doubling_dedup.op7_doubling_dedup,
    simhash.op8_simhash_tiles,
    url_filter.op9_redirect_url_filter,
    exact_dedup.op10_cuckoo_exact_dedup,
    neighbours.op11_projected_neighbours,
    conversation_repair.op12_conversation_repair,
    token_alignment.op13_token_alignment,
)}
ORACLES = {
    "op5_quality_cascade": quality.OP5_SQL,
    "op9_redirect_url_filter": url_filter.OP9_SQL,
    "op10_cuckoo_exact_dedup": exact_dedup.OP10_SQL,
}
