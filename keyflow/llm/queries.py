"""Registered queries of the text operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (align, decontaminate, html_text, licenses, line_dedup, lm_score, near_dup, packing, quality, spelling,
               substring_dedup, toxicity, word_bpe)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": line_dedup.op1_line_dedup,
        "op2_license_scan": licenses.op2_license_scan,
        "op3_quality_rules": quality.op3_quality_rules,
        "op4_benchmark_overlap": decontaminate.op4_benchmark_overlap,
        "op5_best_fit_packing": packing.op5_best_fit_packing,
        "op6_toxicity": toxicity.op6_toxicity,
        "op7_substring_dedup": substring_dedup.op7_substring_dedup,
        "op8_near_duplicates": near_dup.op8_near_duplicates,
        "op9_html_text": html_text.op9_html_text,
        "op10_lm_score": lm_score.op10_lm_score,
        "op11_token_alignment": align.op11_token_alignment,
        "op12_word_bpe": word_bpe.op12_word_bpe,
        "op13_spelling_variants": spelling.op13_spelling_variants,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": line_dedup.oracle(),
        "op2_license_scan": licenses.oracle(),
        "op3_quality_rules": quality.oracle(),
        "op7_substring_dedup": substring_dedup.oracle(),
        "op8_near_duplicates": near_dup.oracle(),
    }
