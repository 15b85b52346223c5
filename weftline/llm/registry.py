"""Queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from . import html_text, jaccard, language, mixing, quality, sampling, secrets, sharding, topk, toxicity

QUERIES = {
    f.__name__: f
    for f in (
        language.op1_language_id,
        quality.op2_quality_rules,
        toxicity.op3_toxicity,
        topk.op4_exact_topk,
        sampling.op5_sentencepiece_sampling,
        jaccard.op6_ngram_jaccard_join,
        sharding.op7_sharding,
        secrets.op8_secret_scans,
        mixing.op9_mixing,
        html_text.op10_html_extraction,
    )
}
ORACLE_SQL = {
    "op2_quality_rules": quality.OP2_SQL,
    "op4_exact_topk": topk.OP4_SQL,
    "op7_sharding": sharding.OP7_SQL,
    "op8_secret_scans": secrets.OP8_SQL,
}
