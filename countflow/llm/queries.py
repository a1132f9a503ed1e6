"""The registered queries of the text operators, with the SQL that checks those that SQL can express."""

from __future__ import annotations

from countflow.llm import byte_bpe, centroids, exact_dedup, language_model, lexical_search, line_dedup, merge_bpe, packing, quality, sharding, simhash, token_files, toxicity

QUERIES = {
    "op1_lm_scoring": language_model.op1_lm_scoring,
    "op2_simhash": simhash.op2_simhash,
    "op3_line_dedup": line_dedup.op3_line_dedup,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_quality": quality.op6_quality,
    "op7_shard": sharding.op7_shard,
    "op8_best_fit_packing": packing.op8_best_fit_packing,
    "op9_byte_bpe": byte_bpe.op9_byte_bpe,
    "op10_token_files": token_files.op10_token_files,
    "op11_lexical_search": lexical_search.op11_lexical_search,
    "op12_centroids": centroids.op12_centroids,
    "op13_bpe": merge_bpe.op13_bpe,
}

ORACLE_SQL = {"op5_exact_dedup": exact_dedup.OP5_SQL, "op11_lexical_search": lexical_search.OP11_SQL, "op12_centroids": centroids.OP12_SQL}
