"""The queries opN_<name> and their SQL."""

from __future__ import annotations

import corpus_pipeline

from . import bitslice, decontaminate, html_extract, line_dedup, packing, pii, quality, simhash, substring, toxicity
from .common import table


def queries() -> dict:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_html_consensus": lambda spark, d: html_extract.query(table(spark, d, "pages")),
        "op2_line_dedup": lambda spark, d: line_dedup.query(table(spark, d, "documents")),
        "op3_bitslice_topk": lambda spark, d: bitslice.query(table(spark, d, "embeddings")),
        "op4_cotrained_quality": lambda spark, d: quality.query(table(spark, d, "documents"), table(spark, d, "labels")),
        "op5_simhash_bktree": lambda spark, d: simhash.query(table(spark, d, "documents")),
        "op6_debruijn_dedup": lambda spark, d: substring.query(table(spark, d, "documents")),
        "op7_bin_slack_packing": lambda spark, d: packing.query(table(spark, d, "documents")),
        "op8_pii": lambda spark, d: pii.query(table(spark, d, "documents")),
        "op9_toxicity": lambda spark, d: toxicity.query(table(spark, d, "documents"), table(spark, d, "labels")),
        "op10_decontaminate": lambda spark, d: decontaminate.query(table(spark, d, "documents"), table(spark, d, "benchmark")),
    }


def oracle_sql() -> dict[str, str]:
    """No entry for the pipeline, op1, op4, op5, op7, op8 and op9: parsing, trained models, XXH64,
    tokens, Luhn and mod-97 sums with positions are beyond what SQL says plainly; tests/llm holds
    them against brute force."""
    return {
        "op2_line_dedup": line_dedup.ORACLE,
        "op3_bitslice_topk": bitslice.ORACLE,
        "op6_debruijn_dedup": substring.ORACLE,
        "op10_decontaminate": decontaminate.ORACLE,
    }
