"""The training-data queries and the DuckDB twins of those that SQL can express."""

from __future__ import annotations

from sluice.llm import (
    collocations,
    decontaminate,
    jaccard,
    laesa,
    language_id,
    line_dedup,
    merkle,
    mixing,
    packing,
    preference,
    token_counts,
    token_files,
    toxicity,
)

QUERIES = {
    "op1_preference": preference.op1_preference,
    "op2_fingerprints": merkle.op2_fingerprints,
    "op3_language_id": language_id.op3_language_id,
    "op4_token_counts": token_counts.op4_token_counts,
    "op5_jaccard": jaccard.op5_jaccard,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_token_files": token_files.op7_token_files,
    "op8_decontaminate": decontaminate.op8_decontaminate,
    "op9_line_dedup": line_dedup.op9_line_dedup,
    "op10_mixing": mixing.op10_mixing,
    "op11_vector_codes": laesa.op11_vector_codes,
    "op12_collocations": collocations.op12_collocations,
    "op13_packing": packing.op13_packing,
}

ORACLE_SQL = {
    "op1_preference": preference.OP1_SQL,
    "op9_line_dedup": line_dedup.OP9_SQL,
    "op10_mixing": mixing.OP10_SQL,
    "op11_vector_codes": laesa.OP11_SQL,
    "op12_collocations": collocations.OP12_SQL,
}
