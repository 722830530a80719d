"""op5: every document in a shard of a bounded number of text bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curata.llm import sharding
from curata.llm.common import table

#: Text bytes of a shard at most.
SHARD_BYTES = 1 << 20


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.assign(docs, SHARD_BYTES).select("doc_id", "shard", "depth", "shard_bytes", "shard_docs")


QUERIES = {"op5_shards": op5_shards}

SQL = {
    "op5_shards": f"""
WITH d AS (SELECT doc_id, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS h, coalesce(strlen(text), 0) AS b FROM documents),
l AS (SELECT unnest(range(0, 31)) AS depth),
s AS (SELECT depth, h >> (60 - depth) AS prefix, sum(b) AS shard_bytes, count(*) AS shard_docs FROM d, l GROUP BY ALL),
c AS (SELECT d.doc_id, d.h, min(l.depth) AS depth FROM d, l JOIN s ON s.depth = l.depth WHERE s.prefix = d.h >> (60 - l.depth) AND s.shard_bytes <= {SHARD_BYTES} GROUP BY ALL)
SELECT c.doc_id, CASE WHEN c.depth = 0 THEN '' ELSE substr(lpad(bin(c.h >> (60 - c.depth)), 64, '0'), 65 - c.depth) END AS shard, CAST(c.depth AS BIGINT) AS depth,
  CAST(s.shard_bytes AS BIGINT) AS shard_bytes, CAST(s.shard_docs AS BIGINT) AS shard_docs
FROM c JOIN s ON s.depth = c.depth AND s.prefix = c.h >> (60 - c.depth)"""
}
