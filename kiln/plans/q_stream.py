"""Micro-batch k-means on Structured Streaming (T1-T5) over ``embeddings``."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from kiln.operators import kmeans as km
from kiln.operators import stats as st
from kiln.plans.registry import query
from kiln.session import shared_path
from kiln.sources.io import read_table
from kiln.streaming import microbatch_kmeans as mk

K = 10


def _stream(spark, sf_dir, n_batches):
    e = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    base = shared_path(spark, "microbatches")
    batches = os.path.join(base, "batches")
    files = mk.write_microbatches(e, "vec_id", n_batches, batches)
    res = mk.run(spark, batches, e.schema, "embedding", "vec_id", K, alpha=1.0, seed=0, files_per_batch=files,
                 work_dir=os.path.join(base, "run"))
    return e, res


def _rounds_sql(n_batches: int) -> str:
    """The whole stream written out: batch numbers, start rows, and per batch
    the distances, the assignment, the means and the weighted update."""
    ctes = [f"""
p AS (SELECT vec_id, label, list_transform(embedding, lambda v: v::DOUBLE) AS x,
             (row_number() OVER (ORDER BY vec_id) - 1) % {n_batches} AS batch FROM embeddings),
s0 AS (SELECT cluster, x AS c, 0.0::DOUBLE AS w FROM (
         SELECT (row_number() OVER (ORDER BY md5('0:' || vec_id::varchar), vec_id) - 1)::INTEGER AS cluster, x
         FROM p WHERE batch = 0) WHERE cluster < {K})"""]
    for t in range(n_batches + 1):
        rows = f"SELECT * FROM p WHERE batch = {t}" if t < n_batches else "SELECT * FROM p"
        ctes.append(f"""
a{t} AS (SELECT vec_id, label, x, cluster FROM (
  SELECT r.*, s.cluster, row_number() OVER (PARTITION BY vec_id ORDER BY list_sum(list_transform(
    list_zip(r.x, s.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), s.cluster) AS rn
  FROM ({rows}) r CROSS JOIN s{t} s) WHERE rn = 1),
n{t} AS (SELECT cluster, count(*) AS n FROM a{t} GROUP BY cluster),
m{t} AS (SELECT cluster, list(m ORDER BY j) AS mean FROM (
  SELECT cluster, j, avg(v) AS m FROM (SELECT cluster, unnest(x) AS v, unnest(range(1, len(x) + 1)) AS j FROM a{t})
  GROUP BY cluster, j) GROUP BY cluster),
s{t + 1} AS (SELECT s.cluster, s.w + coalesce(n.n, 0) AS w, CASE WHEN n.n IS NULL THEN s.c ELSE
  list_transform(list_zip(s.c, m.mean), lambda z: (s.w * z[1] + n.n * z[2]) / (s.w + n.n)) END AS c
  FROM s{t} s LEFT JOIN n{t} n USING (cluster) LEFT JOIN m{t} m USING (cluster))""")
    return "WITH " + ",".join(ctes)


@query("microbatch_kmeans", sql=_rounds_sql(5) + """
SELECT cluster, sum(n)::BIGINT AS size, round(max(n) / sum(n), 9) AS purity
FROM (SELECT cluster, label, count(*) AS n FROM a5 GROUP BY cluster, label) GROUP BY cluster
""")
def q_microbatch_kmeans(spark, sf_dir):
    """5 interleaved micro-batches streamed through the decayed k-means
    update (alpha = 1); the whole table is then scored with the final state
    and each cluster's size and purity reported."""
    e, res = _stream(spark, sf_dir, 5)
    cents = [list(r["centroid"]) for r in mk.final_state(spark, res).orderBy("cluster").collect()]
    p = st.purity(km.composition(e, "embedding", "label", cents))
    return p.select("cluster", "size", F.round("purity", 9).alias("purity"))


@query("microbatch_counts", sql=_rounds_sql(5) + " " + " UNION ALL ".join(f"""
SELECT {t}::BIGINT AS batch_id, s.cluster, coalesce(n.n, 0)::BIGINT AS n,
       round(s{t + 1}.w, 6) AS weight_after FROM s{t} s LEFT JOIN n{t} n USING (cluster) JOIN s{t + 1} USING (cluster)
""" for t in range(5)))
def q_microbatch_counts(spark, sf_dir):
    """T4: rows per cluster of every batch, counted before its update, and the
    cluster's weight after it."""
    _, res = _stream(spark, sf_dir, 5)
    after = spark.read.schema(f"{mk.STATE}, b long").parquet(res.state_path) \
        .select(F.col("b").alias("batch_id"), "cluster", F.round("weight", 6).alias("weight_after"))
    return mk.batch_counts(spark, res).join(F.broadcast(after), ["batch_id", "cluster"])


@query("microbatch_kmeans_one", sql="""
WITH c AS (SELECT (row_number() OVER (ORDER BY md5('0:' || vec_id::varchar), vec_id) - 1)::INTEGER AS cluster,
                  embedding AS ce FROM embeddings QUALIFY cluster < 10),
dist AS (SELECT e.vec_id, e.embedding, c.cluster,
         list_sum(list_transform(range(1, len(e.embedding) + 1),
                  lambda i: (e.embedding[i]::DOUBLE - c.ce[i]::DOUBLE) * (e.embedding[i]::DOUBLE - c.ce[i]::DOUBLE))) AS d
         FROM embeddings e CROSS JOIN c),
asg AS (SELECT vec_id, embedding, cluster FROM (
          SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) AS rn FROM dist) WHERE rn = 1),
ex AS (SELECT cluster, unnest(embedding)::DOUBLE AS v, unnest(range(1, len(embedding) + 1)) AS j FROM asg),
m AS (SELECT cluster, list(m ORDER BY j) AS mean FROM (SELECT cluster, j, avg(v) AS m FROM ex GROUP BY cluster, j)
      GROUP BY cluster),
n AS (SELECT cluster, count(*) AS n FROM asg GROUP BY cluster)
SELECT c.cluster, coalesce(n.n, 0)::DOUBLE AS weight,
       list_transform(coalesce(m.mean, list_transform(c.ce, lambda v: v::DOUBLE)), lambda v: round(v, 6)) AS centroid
FROM c LEFT JOIN m USING (cluster) LEFT JOIN n USING (cluster)
""")
def q_microbatch_kmeans_one(spark, sf_dir):
    """T2 with a single batch and alpha = 1: the state equals one k-means
    round from the seeded sample -- an exact check of the streaming update."""
    _, res = _stream(spark, sf_dir, 1)
    s = mk.final_state(spark, res)
    return s.select("cluster", "weight", F.transform("centroid", lambda v: F.round(v, 6)).alias("centroid"))
