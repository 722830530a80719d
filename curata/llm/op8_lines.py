"""op8: lines found in ten documents or more are dropped everywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.llm import line_dedup
from curata.llm.common import table


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cleaned = line_dedup.drop_lines(docs, least_docs=10)
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES = {"op8_line_dedup": op8_line_dedup}

SQL = {
    "op8_line_dedup": r"""
WITH l AS (
  SELECT doc_id, t.i AS pos, t.line, translate(regexp_replace(t.line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x, i: {'i': i, 'line': x})) AS t FROM documents)),
hot AS (SELECT k FROM l WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(hot.k) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(l.line, chr(10) ORDER BY pos) FILTER (WHERE hot.k IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN hot ON l.k = hot.k GROUP BY doc_id"""
}
