"""op9: BPE encoding and decoding of every document."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from curata.llm import bpe
from curata.llm.common import table


def default_vocabulary() -> str:
    """The byte-level BPE file that every node has installed."""
    import public_tokenizers

    return os.environ.get("CURATA_BPE_FILE") or public_tokenizers.path("byte_bpe_50k.json")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(docs, default_vocabulary()).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


QUERIES = {"op9_bpe": op9_bpe}
SQL: dict[str, str] = {}
