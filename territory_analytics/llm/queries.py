"""Registered queries of this subpackage, and their SQL where SQL can express them."""

from . import (
    backoff, decontaminate, exact, extraction, importance, mixing, passages, quality, runs, simhash, tokens, toxicity, warc,
)

QUERIES = {
    "op1_toxicity": toxicity.score_toxicity,
    "op2_warc_round_trip": warc.warc_round_trip,
    "op3_token_planes": tokens.token_planes,
    "op4_simhash_near_dedup": simhash.simhash_near_dedup,
    "op5_lm_backoff": backoff.lm_backoff,
    "op6_mixing": mixing.mixing,
    "op7_exact_dedup": exact.exact_dedup,
    "op8_benchmark_decontamination": decontaminate.benchmark_decontamination,
    "op9_repeated_passages": passages.repeats,
    "op10_quality_classifier": quality.score_quality,
    "op11_html_extraction": extraction.main_text,
    "op12_periodic_runs": runs.periodic_runs,
    "op13_importance_resampling": importance.importance_resampling,
}

ORACLE = {
    "op2_warc_round_trip": warc.ORACLE,
    "op5_lm_backoff": backoff.ORACLE,
    "op6_mixing": mixing.ORACLE,
    "op7_exact_dedup": exact.ORACLE,
    "op8_benchmark_decontamination": decontaminate.ORACLE,
    "op13_importance_resampling": importance.ORACLE,
}
