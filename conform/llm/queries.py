"""The registered queries of the operators, and their SQL where SQL can say it."""

from __future__ import annotations

from conform.llm import audit, hard_negatives, line_rules, near_dup, pieces, quality, quotes, secrets, tiling, token_counts, top_k, toxicity, warc
from conform.llm.common import Plan

QUERIES: dict[str, Plan] = {
    "op1_token_counts": token_counts.op1_token_counts,
    "op2_near_duplicates": near_dup.op2_near_duplicates,
    "op3_top_k": top_k.op3_top_k,
    "op4_quality": quality.op4_quality,
    "op5_pieces": pieces.op5_pieces,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_secret_scan": secrets.op7_secret_scan,
    "op8_warc": warc.op8_warc,
    "op9_chat": quotes.op9_chat,
    "op10_decontamination": tiling.op10_decontamination,
    "op11_filter_audit": audit.op11_filter_audit,
    "op12_quality_rules": line_rules.op12_quality_rules,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}
ORACLES: dict[str, str] = {
    "op2_near_duplicates": near_dup.SQL,
    "op3_top_k": top_k.SQL,
    "op7_secret_scan": secrets.SQL,
    "op8_warc": warc.SQL,
    "op11_filter_audit": audit.SQL,
    "op12_quality_rules": line_rules.SQL,
    "op13_hard_negatives": hard_negatives.SQL,
}
