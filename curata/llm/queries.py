"""The registered queries of the training-data operators, and their SQL where DuckDB can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from curata.llm import op1_quality, op2_suffixes, op3_chat, op4_substrings, op5_shards, op6_benchmark, op7_jaccard, op8_lines, op9_bpe, op10_licenses, op11_media, op12_clusters, op13_runs

_MODULES = [op1_quality, op2_suffixes, op3_chat, op4_substrings, op5_shards, op6_benchmark, op7_jaccard, op8_lines, op9_bpe, op10_licenses, op11_media, op12_clusters, op13_runs]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in _MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.SQL.items()}
