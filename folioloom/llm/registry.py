"""Names of the corpus queries: the function and, where SQL can express it, the SQL."""

from __future__ import annotations

import corpus_pipeline
from folioloom.llm import bpe, decontaminate, html_extract, licenses, lm_score, merkle, periodic_runs, quality, secret_scan, simhash, suffix_dedup, toxicity, warc

_ALL = {
    "op1_quality_rules": (quality.op1_quality_rules, quality.OP1_SQL),
    "op2_secret_scan": (secret_scan.op2_secret_scan, None),
    "op3_license_scan": (licenses.op3_license_scan, None),
    "op4_warc_round_trip": (warc.op4_warc_round_trip, warc.OP4_SQL),
    "op5_html_text": (html_extract.op5_html_text, None),
    "op6_suffix_dedup": (suffix_dedup.op6_suffix_dedup, None),
    "op7_simhash_dedup": (simhash.op7_simhash_dedup, None),
    "op8_bpe_round_trip": (bpe.op8_bpe_round_trip, None),
    "op9_decontamination": (decontaminate.op9_decontamination, None),
    "op10_toxicity": (toxicity.op10_toxicity, None),
    "op11_lm_score": (lm_score.op11_lm_score, None),
    "op12_periodic_runs": (periodic_runs.op12_periodic_runs, periodic_runs.OP12_SQL),
    "op13_merkle_manifest": (merkle.op13_merkle_manifest, merkle.OP13_SQL),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}


def queries() -> dict:
    return {name: f for name, (f, _) in _ALL.items()}


def oracle_sql() -> dict:
    return {name: sql for name, (_, sql) in _ALL.items() if sql}
