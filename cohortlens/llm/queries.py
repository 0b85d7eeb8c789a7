"""Named queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm import (
    decontaminate,
    html_text,
    language_id,
    lexical_search,
    license_scan,
    line_dedup,
    merkle,
    ngram_join,
    packing,
    pii,
    quality,
    simhash,
    suffix_dedup,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_join": ngram_join.op1_ngram_join,
        "op2_line_dedup": line_dedup.op2_line_dedup,
        "op3_packing": packing.op3_packing,
        "op4_pii": pii.op4_pii,
        "op5_language_id": language_id.op5_language_id,
        "op6_license_scan": license_scan.op6_license_scan,
        "op7_suffix_dedup": suffix_dedup.op7_suffix_dedup,
        "op8_html_text": html_text.op8_html_text,
        "op9_quality": quality.op9_quality,
        "op10_decontaminate": decontaminate.op10_decontaminate,
        "op11_merkle_manifest": merkle.op11_merkle_manifest,
        "op12_lexical_search": lexical_search.op12_lexical_search,
        "op13_simhash": simhash.op13_simhash,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_ngram_join": ngram_join.OP1_SQL,
        "op2_line_dedup": line_dedup.OP2_SQL,
        "op6_license_scan": license_scan.op6_sql(),
        "op11_merkle_manifest": merkle.OP11_SQL,
        "op12_lexical_search": lexical_search.OP12_SQL,
    }
