"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillwork.llm import (
    bpe,
    decontamination,
    filter_audit,
    html_extraction,
    jaccard_join,
    language_id,
    lexical_search,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    suffix_dedup,
    url_filters,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_array_dedup": suffix_dedup.op1,
    "op2_url_filters": url_filters.op2,
    "op3_benchmark_decontamination": decontamination.op3,
    "op4_pii": pii.op4,
    "op5_quality_rules": quality_rules.op5,
    "op6_language_id": language_id.op6,
    "op7_bpe": bpe.op7,
    "op8_ngram_jaccard_join": jaccard_join.op8,
    "op9_html_extraction": html_extraction.op9,
    "op10_quality_classifier": quality_classifier.op10,
    "op11_filter_audit": filter_audit.op11,
    "op12_lexical_search": lexical_search.op12,
    "op13_best_fit_packing": packing.op13,
}

ORACLES: dict[str, str] = {
    "op2_url_filters": url_filters.OP2_SQL,
    "op3_benchmark_decontamination": decontamination.OP3_SQL,
    "op5_quality_rules": quality_rules.OP5_SQL,
    "op11_filter_audit": filter_audit.OP11_SQL,
    "op12_lexical_search": lexical_search.OP12_SQL,
}
