"""The queries of this subpackage, one for each operator, and their SQL where SQL expresses them.

None has SQL: tokenizers, trained models, XXH64 and suffix searches are beyond it, or, as for
lines and windows, far too slow in it over whole tables. tests/llm holds each query against
brute force instead.
"""

from __future__ import annotations

from vaultflow.llm import decontamination, fingerprints, line_dedup, lm_scoring, packing, quality, secrets, simhash, token_counts, toxicity

QUERIES = {
    "op1_secrets": secrets.op1_secrets,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_packing": packing.op3_pack,
    "op4_decontamination": decontamination.op4_decontamination,
    "op5_fingerprints": fingerprints.op5_fingerprints,
    "op6_lm_scoring": lm_scoring.op6_lm_scoring,
    "op7_simhash": simhash.op7_simhash,
    "op8_quality": quality.op8_quality,
    "op9_line_dedup": line_dedup.op9_line_dedup,
    "op10_token_counts": token_counts.op10_token_counts,
}

ORACLE_SQL: dict[str, str] = {}
