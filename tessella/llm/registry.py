"""Queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from . import langid, mixing, neardup, packing, pii, quality, scoring, search, suffixes, toxicity

QUERIES = {
    "op1_lm_score": scoring.op1_lm_score,
    "op2_topk": search.op2_topk,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_substrings": suffixes.op4_substrings,
    "op5_mix": mixing.op5_mix,
    "op6_pii": pii.op6_pii,
    "pii_base_spans": pii.pii_base_spans,
    "op7_packing": packing.op7_packing,
    "op8_neardup": neardup.op8_neardup,
    "op9_host_quality": quality.op9_host_quality,
    "op10_langid": langid.op10_langid,
}
SQL = {"op2_topk": search.OP2_SQL, "op5_mix": mixing.OP5_SQL, "pii_base_spans": pii.BASE_SQL, "op9_host_quality": quality.OP9_SQL}
