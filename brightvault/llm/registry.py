"""The training-data queries by name, and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from brightvault.llm import audit, chains, chat, divergence, exact, langid, lines, mixing, quality, rules, simhash, tokens, urls

QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_exact": exact.op2_exact,
    "op3_chat": chat.op3_chat,
    "op4_passages": chains.op4_passages,
    "op5_rules": rules.op5_rules,
    "rule_ablations": rules.rule_ablations,
    "op6_language": langid.op6_language,
    "op7_lines": lines.op7_lines,
    "op8_mixing": mixing.op8_mixing,
    "op9_bpe": tokens.op9_bpe,
    "op10_simhash": simhash.op10_simhash,
    "op11_interactions": audit.op11_interactions,
    "op12_urls": urls.op12_urls,
    "op13_divergence": divergence.op13_divergence,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op2_exact": exact.OP2_SQL,
    "op3_chat": chat.OP3_SQL,
    "op5_rules": rules.OP5_SQL,
    "rule_ablations": rules.ABLATION_SQL,
    "op7_lines": lines.OP7_SQL,
    "op8_mixing": mixing.OP8_SQL,
    "op11_interactions": audit.OP11_SQL,
    "op12_urls": urls.OP12_SQL,
    "op13_divergence": divergence.OP13_SQL,
}
