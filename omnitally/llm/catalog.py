"""The registered queries of the package and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline
from omnitally.llm import (op1_secrets, op2_chat, op3_decontamination, op4_line_dedup, op5_tokens, op6_pii,
                           op7_sharding, op8_mixing, op9_simhash, op10_quality, op11_collocations,
                           op12_resampling, op13_compression)

QUERIES = {
    "op1_secret_links": op1_secrets.query,
    "op2_chat_trees": op2_chat.query,
    "op3_decontamination": op3_decontamination.query,
    "op4_line_dedup": op4_line_dedup.query,
    "op5_wavelet_tokens": op5_tokens.query,
    "op6_pii_spans": op6_pii.query,
    "op7_kd_shards": op7_sharding.query,
    "op8_source_mix": op8_mixing.query,
    "op9_simhash_bktree": op9_simhash.query,
    "op10_quality_fences": op10_quality.query,
    "op11_collocations": op11_collocations.query,
    "op12_resampling": op12_resampling.query,
    "op13_compression": op13_compression.query,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {"op2_chat_trees": op2_chat.ORACLE, "op8_source_mix": op8_mixing.ORACLE,
           "op11_collocations": op11_collocations.ORACLE,
           "op12_resampling": op12_resampling.ORACLE}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
