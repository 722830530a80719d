"""op6: documents that hold a benchmark item's question and answer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curata.llm import decontaminate
from curata.llm.common import table


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return decontaminate.leaks(docs, items, threshold=0.6, least_overlap=0.8)


QUERIES = {"op6_decontamination": op6_decontamination}
SQL: dict[str, str] = {}
