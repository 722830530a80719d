"""op2: bytes in 200-byte strings that also start anywhere else are removed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curata.llm import suffix_dedup
from curata.llm.common import table


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.removed(table(spark, sf_dir, "documents").select("doc_id", "text"), window=200)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


QUERIES = {"op2_suffix_dedup": op2_suffix_dedup}
SQL: dict[str, str] = {}
