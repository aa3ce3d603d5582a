"""The queries of the corpus operators and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import chat_format, decontaminate, histogram_shards, jaccard_join, language_id, quality_rules, sequence_packing, substring_dedup, token_counts, url_filter


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_rules": quality_rules.op1_quality_rules,
        "op2_sequence_packing": sequence_packing.op2_sequence_packing,
        "op3_url_filter": url_filter.op3_url_filter,
        "op4_histogram_shards": histogram_shards.op4_histogram_shards,
        "op5_language_id": language_id.op5_language_id,
        "op6_decontaminate": decontaminate.op6_decontaminate,
        "op7_substring_dedup": substring_dedup.op7_substring_dedup,
        "op8_token_counts": token_counts.op8_token_counts,
        "op9_chat_formatting": chat_format.op9_chat_formatting,
        "op10_jaccard_join": jaccard_join.op10_jaccard_join,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_url_filter": url_filter.SQL,
        "op6_decontaminate": decontaminate.SQL,
        "op7_substring_dedup": substring_dedup.SQL,
        "op9_chat_formatting": chat_format.SQL,
    }
