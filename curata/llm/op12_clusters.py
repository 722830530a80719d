"""op12: the embeddings in eight clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curata.llm import ball_tree
from curata.llm.common import table

K, ROUNDS, DIMS, SCALE, SEED = 8, 10, 64, 1024, "3"


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.described(*ball_tree.clusters(table(spark, sf_dir, "embeddings"), k=K, rounds=ROUNDS, dims=DIMS, scale=SCALE, seed=SEED))


def _sql() -> str:
    """The rounds one after the other: points and centroids by component, exact integers throughout."""

    def assigned(n: int) -> str:
        return f"""a{n} AS MATERIALIZED (
  SELECT row_id, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance
  FROM (SELECT p.row_id, c.cluster, sum((p.x - c.x) * (p.x - c.x)) AS d FROM points p JOIN c{n} c ON p.k = c.k GROUP BY p.row_id, c.cluster) GROUP BY row_id)"""

    def centroids(n: int) -> str:
        return f"""c{n + 1} AS MATERIALIZED (
  SELECT c.cluster, c.k, coalesce(m.x, c.x) AS x FROM c{n} c
  LEFT JOIN (SELECT a.cluster, p.k, CAST(sum(p.x) // count(*) - CASE WHEN sum(p.x) % count(*) < 0 THEN 1 ELSE 0 END AS HUGEINT) AS x FROM points p JOIN a{n} a ON p.row_id = a.row_id GROUP BY a.cluster, p.k) m
  ON c.cluster = m.cluster AND c.k = m.k)"""

    steps = ", ".join(x for n in range(ROUNDS) for x in (assigned(n), centroids(n)))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS HUGEINT)) AS v
  FROM embeddings WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
points AS MATERIALIZED (SELECT row_id, generate_subscripts(v, 1) AS k, unnest(v) AS x FROM kept),
first AS (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || CAST(vec_id AS VARCHAR)) NULLS LAST, v) - 1 AS cluster, v FROM kept QUALIFY cluster < {K}),
c0 AS MATERIALIZED (SELECT cluster, generate_subscripts(v, 1) AS k, unnest(v) AS x FROM first), {steps}, {assigned(ROUNDS)},
named AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY k)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY cluster)
SELECT kept.vec_id, CAST(a.cluster AS INTEGER) AS cluster, CAST(a.distance AS BIGINT) AS distance, CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{ROUNDS} a JOIN kept ON kept.row_id = a.row_id JOIN named ON named.cluster = a.cluster"""


QUERIES = {"op12_centroid_clustering": op12_centroid_clustering}
SQL = {"op12_centroid_clustering": _sql()}
