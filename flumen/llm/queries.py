"""The registered corpus queries and, where SQL can state them, their DuckDB oracles."""

from __future__ import annotations

from flumen.llm import (ann, bpe, decontaminate, divergence, langid, licences, ngramlm, rankbpe, simhash, suffixdedup, tokencount,
                        urlfilter, wordruns)

QUERIES = {
    "op1_suffix_array_dedup": suffixdedup.query,
    "op2_benchmark_decontamination": decontaminate.query,
    "op7_license_scan": licences.query,
    "op5_nearest_neighbours": ann.query,
    "op6_simhash_near_dedup": simhash.query,
    "op8_bpe_encode_decode": bpe.query,
    "op3_url_filters": urlfilter.query,
    "op4_token_counts": tokencount.query,
    "op9_lm_scoring": ngramlm.query,
    "op10_language_id": langid.query,
    "op11_periodic_runs": wordruns.query,
    "op12_source_divergence": divergence.query,
    "op13_rank_queue_bpe": rankbpe.query,
}

ORACLES: dict[str, str] = {
    "op2_benchmark_decontamination": decontaminate.ORACLE,
    "op7_license_scan": licences.ORACLE,
    "op3_url_filters": urlfilter.ORACLE,
    "op12_source_divergence": divergence.ORACLE,
}
