"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from orrery.llm import decontaminate, html_text, line_dedup, lm_score, mixing, near_dedup, phrases, pii, quality, token_align, token_files, toxicity, warc

QUERIES = {
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_pii": pii.op3_pii,
    "op4_warc": warc.op4_warc,
    "op5_lm_score": lm_score.op5_lm_score,
    "op6_near_dedup": near_dedup.op6_near_dedup,
    "op1_quality": quality.op1_quality,
    "op7_html_text": html_text.op7_html_text,
    "op8_decontaminate": decontaminate.op8_decontaminate,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_mixing": mixing.op10_mixing,
    "op11_token_alignment": token_align.op11_token_alignment,
    "op12_token_files": token_files.op12_token_files,
    "op13_phrases": phrases.op13_phrases,
}

ORACLE = {
    "op1_quality": quality.SQL,
    "op2_line_dedup": line_dedup.SQL,
    "op4_warc": warc.SQL,
    "op5_lm_score": lm_score.SQL,
    "op6_near_dedup": near_dedup.SQL,
    "op10_mixing": mixing.SQL,
    "op13_phrases": phrases.SQL,
}
