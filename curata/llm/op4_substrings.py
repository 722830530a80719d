"""op4: words in 13-word windows that a document with a smaller doc_id holds are removed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curata.llm import substring_dedup
from curata.llm.common import table


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.removed(table(spark, sf_dir, "documents").select("doc_id", "text"), window=13)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


QUERIES = {"op4_substring_dedup": op4_substring_dedup}

SQL = {
    "op4_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM d WHERE len(w) >= 13),
h AS (SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS g FROM g),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) < doc_id AS dup FROM h),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM f WHERE dup),
u AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(r.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT doc_id, count(*) AS n FROM c GROUP BY doc_id) r ON r.doc_id = d.doc_id
LEFT JOIN (SELECT u.doc_id, string_agg(u.word, ' ' ORDER BY u.i) AS t FROM u ANTI JOIN c ON c.doc_id = u.doc_id AND c.i = u.i GROUP BY u.doc_id) k ON k.doc_id = d.doc_id"""
}
