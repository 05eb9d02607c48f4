"""Queries of the subpackage, one per operator plus the pipeline, and the DuckDB SQL
of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from sintonia.llm.budget_mix import op1_budget_mix
from sintonia.llm.context_mix import op5_context_mixing
from sintonia.llm.divergence import OP11_SQL, op11_dominance_skyband
from sintonia.llm.exact_dedup import OP8_SQL, op8_heavy_hitter_dedup
from sintonia.llm.license_scan import op4_license_automaton
from sintonia.llm.line_dedup import OP3_SQL, op3_cuckoo_line_dedup
from sintonia.llm.mask_search import OP13_SQL, op13_mask_search
from sintonia.llm.near_dedup import op9_lsh_forest
from sintonia.llm.packing import op10_linear_grouping
from sintonia.llm.quality import op2_compression_bands
from sintonia.llm.secret_ledger import op6_blob_ledger
from sintonia.llm.token_arrow import op12_fixed_list_files
from sintonia.llm.warc_zstd import OP7_SQL, op7_zstd_archives

QUERIES = {
    "op1_budget_mix": op1_budget_mix,
    "op2_compression_bands": op2_compression_bands,
    "op3_cuckoo_line_dedup": op3_cuckoo_line_dedup,
    "op4_license_automaton": op4_license_automaton,
    "op5_context_mixing": op5_context_mixing,
    "op6_blob_ledger": op6_blob_ledger,
    "op7_zstd_archives": op7_zstd_archives,
    "op8_heavy_hitter_dedup": op8_heavy_hitter_dedup,
    "op9_lsh_forest": op9_lsh_forest,
    "op10_linear_grouping": op10_linear_grouping,
    "op11_dominance_skyband": op11_dominance_skyband,
    "op12_fixed_list_files": op12_fixed_list_files,
    "op13_mask_search": op13_mask_search,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op3_cuckoo_line_dedup": OP3_SQL,
    "op7_zstd_archives": OP7_SQL,
    "op8_heavy_hitter_dedup": OP8_SQL,
    "op11_dominance_skyband": OP11_SQL,
    "op13_mask_search": OP13_SQL,
}
