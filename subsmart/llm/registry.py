"""The queries of this subpackage and their SQL."""

from __future__ import annotations

import corpus_pipeline
from subsmart.llm import (
    chat,
    decontamination,
    fingerprints,
    html_text,
    language,
    line_dedup,
    manifest,
    mixing,
    private_data,
    resampling,
    simhash,
    token_counts,
    toxicity,
)

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_html": html_text.op3_html,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_language": language.op5_language,
    "op6_simhash": simhash.op6_simhash,
    "op7_decontamination": decontamination.op7_decontamination,
    "op8_private_data": private_data.op8_private_data,
    "op9_fingerprints": fingerprints.op9_fingerprints,
    "op10_token_counts": token_counts.op10_token_counts,
    "op11_resampling": resampling.op11_resampling,
    "op12_manifest": manifest.op12_manifest,
    "op13_chat": chat.op13_chat,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op1_mixing": mixing.ORACLE,
    "op7_decontamination": decontamination.ORACLE,
    "op11_resampling": resampling.ORACLE,
    "op12_manifest": manifest.ORACLE,
    "op13_chat": chat.ORACLE,
}
