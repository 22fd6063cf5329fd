"""The registered queries of this subpackage and their DuckDB oracles (where SQL can express them)."""

from __future__ import annotations

from copyaudit.llm import (byte_cnn, chat, collocations, divergence, html_text, line_dedup, mixing, packing, quality_rules, secrets,
                           simhash, spotsigs, topk)

QUERIES = {
    "op1_quality_rules": quality_rules.op1_quality_rules,
    "op2_byte_cnn": byte_cnn.op2_byte_cnn,
    "op3_secret_scan": secrets.op3_secret_scan,
    "op4_html_text": html_text.op4_html_text,
    "op5_spotsigs": spotsigs.op5_spotsigs,
    "op6_line_dedup": line_dedup.op6_line_dedup,
    "op7_simhash_golay": simhash.op7_simhash_golay,
    "op8_mix_sources": mixing.op8_mix_sources,
    "op9_chat_format": chat.op9_chat_format,
    "op10_best_fit_packing": packing.op10_best_fit_packing,
    "op11_phrase_collocations": collocations.op11_phrase_collocations,
    "op12_source_divergence": divergence.op12_source_divergence,
    "op13_exact_topk": topk.op13_exact_topk,
}
ORACLES = {
    "op1_quality_rules": quality_rules.OP1_SQL,
    "op8_mix_sources": mixing.OP8_SQL,
    "op9_chat_format": chat.OP9_SQL,
    "op11_phrase_collocations": collocations.OP11_SQL,
    "op12_source_divergence": divergence.OP12_SQL,
    "op13_exact_topk": topk.OP13_SQL,
}
