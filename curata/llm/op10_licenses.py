"""op10: public licences in every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curata.llm import license_scan
from curata.llm.common import table


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), least=0.8)


QUERIES = {"op10_licenses": op10_licenses}
SQL: dict[str, str] = {}
