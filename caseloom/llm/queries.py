"""Queries over the training-data operators, one per operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import bpe, cover_tree, exact_dedup, gru_lm, mixing, near_dedup, quality, sharding, toxicity, warc

QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_embedding_dedup": cover_tree.op2_embedding_dedup,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_lm_scoring": gru_lm.op4_lm_scoring,
    "op5_sharding": sharding.op5_sharding,
    "op6_warc": warc.op6_warc,
    "op7_bpe": bpe.op7_bpe,
    "op8_mixing": mixing.op8_mixing,
    "op9_near_dedup": near_dedup.op9_near_dedup,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
}

ORACLES = {"op10_exact_dedup": exact_dedup.ORACLE}
