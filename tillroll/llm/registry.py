"""The registered training-data queries and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline
from tillroll.llm import ann, chat, decontam, langid, linededup, lmscore, packing, resample, shards, simhash, tokencount, variants, whitening

QUERIES = {
    "op1_best_fit_packing": packing.op1_best_fit_packing,
    "op2_importance_resampling": resample.op2_importance_resampling,
    "op3_cross_entropy_difference": lmscore.op3_cross_entropy_difference,
    "op4_chat_formatting": chat.op4_chat_formatting,
    "op5_minimax_shards": shards.op5_minimax_shards,
    "op6_positional_index": decontam.op6_positional_index,
    "op7_line_dedup": linededup.op7_line_dedup,
    "op8_nearest_centroid": langid.op8_nearest_centroid,
    "op9_simhash": simhash.op9_simhash,
    "op10_block_matrix_knn": ann.op10_block_matrix_knn,
    "op11_token_counts": tokencount.op11_token_counts,
    "op12_spectrum_slicing": whitening.op12_spectrum_slicing,
    "op13_prefix_suffix_tiling": variants.op13_prefix_suffix_tiling,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op4_chat_formatting": chat.OP4_SQL,
    "op6_positional_index": decontam.OP6_SQL,
    "op7_line_dedup": linededup.OP7_SQL,
    "op10_block_matrix_knn": ann.OP10_SQL,
    "op13_prefix_suffix_tiling": variants.OP13_SQL,
}
