"""Registered queries of the text operators and their DuckDB SQL."""

from __future__ import annotations

from tablewright.llm.ann import op6_neighbours
from tablewright.llm.bpe import op1_bpe
from tablewright.llm.exact_dedup import OP5_SQL, op5_exact_dedup
from tablewright.llm.license_scan import OP4_SQL, op4_licenses
from tablewright.llm.minhash import op3_near_duplicates
from tablewright.llm.packing import op2_pack
from tablewright.llm.periodic_runs import op12_periodic_runs
from tablewright.llm.quality import op10_quality
from tablewright.llm.secret_scan import op9_secrets
from tablewright.llm.spelling_variants import op13_spelling_variants
from tablewright.llm.token_counts import op11_token_counts
from tablewright.llm.toxicity import op7_toxicity
from tablewright.llm.warc import OP8_SQL, op8_warc

QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_pack": op2_pack,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_licenses": op4_licenses,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_neighbours": op6_neighbours,
    "op7_toxicity": op7_toxicity,
    "op8_warc": op8_warc,
    "op9_secrets": op9_secrets,
    "op10_quality": op10_quality,
    "op11_token_counts": op11_token_counts,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE_SQL: dict[str, str] = {
    "op4_licenses": OP4_SQL,
    "op5_exact_dedup": OP5_SQL,
    "op8_warc": OP8_SQL,
}
