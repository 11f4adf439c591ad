"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from . import op01_quality_rules, op02_sentencepiece, op03_quality_crf, op04_mixing, op05_substring_dedup, op06_url_filter, op07_html_extraction, op08_exact_topk, op09_token_records, op10_jaccard_join

QUERIES = {
    "op1_quality_rules": op01_quality_rules.query,
    "op2_sentencepiece": op02_sentencepiece.query,
    "op3_quality_crf": op03_quality_crf.query,
    "op4_mixing": op04_mixing.query,
    "op5_substring_dedup": op05_substring_dedup.query,
    "op6_url_filter": op06_url_filter.query,
    "op7_html_extraction": op07_html_extraction.query,
    "op8_exact_topk": op08_exact_topk.query,
    "op9_token_records": op09_token_records.query,
    "op10_jaccard_join": op10_jaccard_join.query,
}

ORACLES = {
    "op4_mixing": op04_mixing.ORACLE,
    "op5_substring_dedup": op05_substring_dedup.ORACLE,
    "op6_url_filter": op06_url_filter.ORACLE,
    "op8_exact_topk": op08_exact_topk.ORACLE,
    "op10_jaccard_join": op10_jaccard_join.ORACLE,
}
