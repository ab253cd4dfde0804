"""The operators' queries by name: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import corpus_pipeline
from carestar.llm import (bpe, chat, covertree, jaccard, langid, mixing, pitman_yor, runs, segments,
                          simhash, substring, toxicity, voronoi)

QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_fingerprints": simhash.op2_fingerprints,
    "op3_lm_score": pitman_yor.op3_lm_score,
    "op4_byte_bpe": bpe.op4_byte_bpe,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_chat_format": chat.op6_chat_format,
    "op7_embedding_dedup": covertree.op7_embedding_dedup,
    "op8_ngram_jaccard": jaccard.op8_ngram_jaccard,
    "op9_substring_dedup": substring.op9_substring_dedup,
    "op10_language_id": langid.op10_language_id,
    "op11_periodic_runs": runs.op11_periodic_runs,
    "op12_exact_top_k": voronoi.op12_exact_top_k,
    "op13_hard_negatives": segments.op13_hard_negatives,
    "pipeline": corpus_pipeline.run,
}

# Where SQL can say it; the other operators are tested in tests/llm against
# brute force, an exact round trip or held-out accuracy.
ORACLE = {
    "op1_mix_sources": mixing.ORACLE_SQL,
    "op9_substring_dedup": substring.ORACLE_SQL,
    "op12_exact_top_k": voronoi.ORACLE_SQL,
    "op13_hard_negatives": segments.ORACLE_SQL,
}
