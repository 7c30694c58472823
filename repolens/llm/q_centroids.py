"""Query op12: clusters of all embeddings."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from . import centroids
from .registry import register, table

K, ROUNDS, DIMENSION, SCALE, SEED = 40, 5, 64, 256, "2:"
MOST = 2 ** 63 - 1          # a greater sum of distances is given as this


def _oracle() -> str:
    kept = f"""WITH kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda v: CAST(floor({SCALE} * CAST(v AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = {DIMENSION} AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = {DIMENSION}),
part AS MATERIALIZED (SELECT vec_id, unnest(x) AS v, unnest(range(1, {DIMENSION + 1})) AS j FROM kept),
c0 AS MATERIALIZED (
  SELECT s.cid, p.j, p.v FROM part p JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY sha256('{SEED}' || CAST(vec_id AS VARCHAR))) - 1 AS cid FROM kept) s
  ON p.vec_id = s.vec_id WHERE s.cid < {K})"""
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, CAST(min(d) AS BIGINT) AS distance, CAST(arg_min(cid, (d, cid)) AS INTEGER) AS cluster FROM (
    SELECT p.vec_id, c.cid, sum((p.v - c.v) * (p.v - c.v)) AS d
    FROM part p JOIN c{r} c ON p.j = c.j GROUP BY p.vec_id, c.cid) GROUP BY vec_id)""")
        if r < ROUNDS:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT o.cid, o.j, CAST(coalesce(m.v, o.v) AS BIGINT) AS v FROM c{r} o LEFT JOIN (
    SELECT a.cluster, p.j, floor(CAST(sum(p.v) AS DOUBLE) / count(*)) AS v
    FROM part p JOIN a{r} a ON p.vec_id = a.vec_id GROUP BY a.cluster, p.j) m ON o.cid = m.cluster AND o.j = m.j)""")
    return f"""{kept},
{",".join(steps)},
sha AS (SELECT cid, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY j)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY cid)
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{ROUNDS} JOIN sha ON cid = cluster"""


@register("op12_centroids", _oracle())
def op12_centroids(spark, sf_dir):
    return digest(centroids.cluster(table(spark, sf_dir, "embeddings"), K, ROUNDS, DIMENSION, SCALE, SEED))


def digest(done: centroids.Clustering):
    """The columns of the query: one row per vector with its cluster's and
    all distances, summed exactly (at most one row a cluster on the driver)."""
    spark = done.assigned.sparkSession
    sums = {r["cluster"]: int(r["d"]) for r in
            done.assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    rows = [(c, min(d, MOST), min(sum(sums.values()), MOST),
             hashlib.sha256(",".join(map(str, done.centroids[c].tolist())).encode()).hexdigest()) for c, d in sums.items()]
    named = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # one row a cluster, K at most
    return (done.assigned.join(F.broadcast(named), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
