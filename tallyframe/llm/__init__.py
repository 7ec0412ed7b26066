"""Operators for training-data pipelines. Nothing else in the library imports this subpackage."""

from __future__ import annotations

from tallyframe.llm.exact_dedup import OP10_SQL, op10_exact_dedup
from tallyframe.llm.fingerprint import op4_fingerprints
from tallyframe.llm.line_dedup import OP1_SQL, op1_line_dedup
from tallyframe.llm.mixing import OP5_SQL, op5_mixing
from tallyframe.llm.near_dedup import op6_near_dedup
from tallyframe.llm.packing import op8_packing
from tallyframe.llm.quality import op2_quality
from tallyframe.llm.secrets import op3_secrets
from tallyframe.llm.sharding import op7_sharding
from tallyframe.llm.token_counts import op9_token_counts


def queries():
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_quality": op2_quality,
        "op3_secrets": op3_secrets,
        "op4_fingerprints": op4_fingerprints,
        "op5_mixing": op5_mixing,
        "op6_near_dedup": op6_near_dedup,
        "op7_sharding": op7_sharding,
        "op8_packing": op8_packing,
        "op9_token_counts": op9_token_counts,
        "op10_exact_dedup": op10_exact_dedup,
    }


def oracle_sql():
    return {"op1_line_dedup": OP1_SQL, "op5_mixing": OP5_SQL, "op10_exact_dedup": OP10_SQL}
