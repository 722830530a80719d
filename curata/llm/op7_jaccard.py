"""op7: components of documents whose 4-word shingle sets have a Jaccard similarity of 0.85 or more."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curata.llm import jaccard
from curata.llm.common import table


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents").select("doc_id", "text"), percent=85, shingle=4)


QUERIES = {"op7_jaccard_join": op7_jaccard_join}

SQL = {
    "op7_jaccard_join": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [w] ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i : i + 3])) END AS s FROM w),
sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n, md5(CAST(list_sort(s) AS VARCHAR)) AS k FROM s),
reps AS (SELECT n, k, min(doc_id) AS rep FROM sizes WHERE n > 0 GROUP BY n, k),
g AS (SELECT doc_id, n, unnest(s) AS g FROM s JOIN sizes USING (doc_id) WHERE doc_id IN (SELECT rep FROM reps)),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT rep AS a, rep AS b FROM reps UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a, min(b) AS c FROM r GROUP BY a)
SELECT sizes.doc_id, sizes.n AS n_shingles, coalesce(c.c, sizes.doc_id) AS component_id
FROM sizes LEFT JOIN reps ON reps.n = sizes.n AND reps.k = sizes.k LEFT JOIN c ON c.a = reps.rep"""
}
