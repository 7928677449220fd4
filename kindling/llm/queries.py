"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from kindling.llm import (alignment, byte_bpe, chat, importance, language_id, line_dedup, near_dup, packing, quality, token_counts, topk_search,
                          toxicity, warc)

QUERIES = {
    "op1_quality_rules": quality.op1_quality_rules,
    "op2_language_id": language_id.op2_language_id,
    "op3_line_dedup": line_dedup.op3_line_dedup,
    "op4_exact_top_k": topk_search.op4_exact_top_k,
    "op5_minhash_near_dup": near_dup.op5_minhash_near_dup,
    "op6_best_fit_packing": packing.op6_best_fit_packing,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_warc": warc.op8_warc,
    "op9_chat_formatting": chat.op9_chat_formatting,
    "op10_byte_bpe": byte_bpe.op10_byte_bpe,
    "op11_importance_resampling": importance.op11_importance_resampling,
    "op12_cross_tokenizer_alignment": alignment.op12_cross_tokenizer_alignment,
    "op13_token_counts": token_counts.op13_token_counts,
}

ORACLE = {
    "op3_line_dedup": line_dedup.OP3_SQL,
    "op4_exact_top_k": topk_search.OP4_SQL,
    "op5_minhash_near_dup": near_dup.OP5_SQL,
    "op8_warc": warc.OP8_SQL,
    "op9_chat_formatting": chat.OP9_SQL,
    "op11_importance_resampling": importance.OP11_SQL,
}
