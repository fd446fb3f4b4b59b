"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from pricelake.llm import ann, bpe, chat, exact, importance, jaccard, mixing, periodic, pii, quality, substring, topk, toxicity

QUERIES = {
    "op1_topk": topk.op1_topk,
    "op2_pii": pii.op2_pii,
    "op3_bpe": bpe.op3_bpe,
    "op4_jaccard_join": jaccard.op4_jaccard_join,
    "op5_nearest": ann.op5_nearest,
    "op6_chat_format": chat.op6_chat_format,
    "op7_mix": mixing.op7_mix,
    "op8_substring": substring.op8_substring,
    "op9_quality": quality.op9_quality,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_periodic": periodic.op11_periodic,
    "op12_exact_dedup": exact.op12_exact_dedup,
    "op13_importance": importance.op13_importance,
}

ORACLES = {
    "op1_topk": topk.ORACLE_OP1,
    "op4_jaccard_join": jaccard.ORACLE_OP4,
    "op6_chat_format": chat.ORACLE_OP6,
    "op8_substring": substring.ORACLE_OP8,
    "op12_exact_dedup": exact.ORACLE_OP12,
    "op13_importance": importance.ORACLE_OP13,
}
