"""The queries of the training-data operators, and SQL where it can express them."""

from __future__ import annotations

from . import block_join, chat, filter_audit, licenses, near_dedup, oracles, order_minhash, packing, product_codes, quality_gam, quality_rules, sentencepieces, suffix_dedup, window_dedup

QUERIES = {
    "op1_licenses": licenses.op1_licenses,
    "op2_sentencepiece": sentencepieces.op2_sentencepiece,
    "op3_quality_gam": quality_gam.op3_quality_gam,
    "op4_near_dedup": near_dedup.op4_near_dedup,
    "op5_packing": packing.op5_packing,
    "op6_window_dedup": window_dedup.op6_window_dedup,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op8_suffix_dedup": suffix_dedup.op8_suffix_dedup,
    "op9_chat": chat.op9_chat,
    "op10_order_minhash": order_minhash.op10_order_minhash,
    "op11_product_codes": product_codes.op11_product_codes,
    "op12_filter_audit": filter_audit.op12_filter_audit,
    "op13_block_join": block_join.op13_block_join,
}
ORACLES = {
    "op4_near_dedup": oracles.NEAR_DEDUP,
    "op6_window_dedup": oracles.WINDOW_DEDUP,
    "op8_suffix_dedup": oracles.SUFFIX_DEDUP,
    "op9_chat": chat.OP9_SQL,
    "op11_product_codes": product_codes.OP11_SQL,
    "op12_filter_audit": filter_audit.OP12_SQL,
    "op13_block_join": block_join.OP13_SQL,
}
