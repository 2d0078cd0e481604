"""k-means and array-function queries on ``embeddings`` (J2, A6, A12, A13,
L13-L15, E6, X15-X20)."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from kiln.functions.arrays import argmax, lit_array, prefix_standardise, sample_category, \
    scale_array, softmax
from kiln.operators import kmeans as km
from kiln.operators import split as sp
from kiln.operators import stats as st
from kiln.plans.registry import query
from kiln.sources.io import read_table

D_CONT = 4
N_SYNTH = 100_000
N_SCORES = 10


def _emb(spark, sf_dir):
    return read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])


def _round_arr(col, digits=6):
    return F.transform(col, lambda v: F.round(v, digits))


@query("prefix_standardise", sql="""
WITH m AS (SELECT avg(embedding[1]) AS m1, stddev_samp(embedding[1]) AS s1,
                  avg(embedding[2]) AS m2, stddev_samp(embedding[2]) AS s2,
                  avg(embedding[3]) AS m3, stddev_samp(embedding[3]) AS s3,
                  avg(embedding[4]) AS m4, stddev_samp(embedding[4]) AS s4 FROM embeddings)
SELECT vec_id, list_transform(
  [(embedding[1] - m1) / s1, (embedding[2] - m2) / s2, (embedding[3] - m3) / s3, (embedding[4] - m4) / s4]
  || list_transform(embedding[5:], lambda v: v::DOUBLE), lambda v: round(v, 6)) AS features
FROM embeddings, m
""")
def q_prefix_standardise(spark, sf_dir):
    """A12 + X15: per-dimension mean and sample std of the first 4 dims, then
    those dims z-scored and the rest passed through."""
    e = _emb(spark, sf_dir)
    p = st.fit_scalars(st.array_moments(e, "embedding", D_CONT, ddof=1))
    z = prefix_standardise("embedding", lit_array(p["mean"]), lit_array(p["std"]), D_CONT)
    return e.select("vec_id", _round_arr(z).alias("features"))


def _label_starts(e):
    """Start centroids: the lowest-id vector of each label, cluster id = the
    label's rank (k = number of labels, collected: k rows)."""
    firsts = e.groupBy("label").agg(F.min("vec_id").alias("vec_id"))
    rows = (e.join(firsts, ["label", "vec_id"], "left_semi")
            .orderBy("label").select("embedding").collect())
    return [list(map(float, r[0])) for r in rows]


_STARTS_SQL = """
WITH c AS (SELECT row_number() OVER (ORDER BY e.label) - 1 AS cid, e.embedding AS ce
           FROM embeddings e JOIN (SELECT label, min(vec_id) AS vec_id FROM embeddings GROUP BY label) f
           USING (label, vec_id)),
dist AS (SELECT e.vec_id, e.label, e.embedding, c.cid,
         list_sum(list_transform(range(1, len(e.embedding) + 1),
                  lambda i: (e.embedding[i]::DOUBLE - c.ce[i]::DOUBLE) * (e.embedding[i]::DOUBLE - c.ce[i]::DOUBLE))) AS d
         FROM embeddings e CROSS JOIN c),
asg AS (SELECT vec_id, label, embedding, cid::INTEGER AS cluster FROM (
          SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, cid) AS rn FROM dist) WHERE rn = 1)
"""


@query("kmeans_assign", sql=_STARTS_SQL + "SELECT vec_id, cluster FROM asg")
def q_kmeans_assign(spark, sf_dir):
    """Nearest of fixed centroids (ties to the lowest id)."""
    e = _emb(spark, sf_dir)
    return km.assign(e, "embedding", _label_starts(e)).select("vec_id", "cluster")


@query("kmeans_round", sql=_STARTS_SQL + """
, ex AS (SELECT cluster, unnest(embedding)::DOUBLE AS v, unnest(range(1, len(embedding) + 1)) AS j FROM asg)
SELECT cluster, n, centroid FROM (
  SELECT cluster, list(round(m, 6) ORDER BY j) AS centroid FROM (
    SELECT cluster, j, avg(v) AS m FROM ex GROUP BY cluster, j) GROUP BY cluster)
JOIN (SELECT cluster, count(*) AS n FROM asg GROUP BY cluster) USING (cluster)
""")
def q_kmeans_round(spark, sf_dir):
    """One Lloyd round -- per cluster, size and mean vector."""
    e = _emb(spark, sf_dir)
    starts = _label_starts(e)
    s = km.cluster_stats(e, "embedding", starts, len(starts[0]))
    return s.select("cluster", "n", _round_arr(F.col("centroid")).alias("centroid"))


@query("kmeans_purity_fixed", sql=_STARTS_SQL + """
, ct AS (SELECT cluster, label, count(*) AS n FROM asg GROUP BY cluster, label)
SELECT cluster, sum(n)::BIGINT AS size, round(max(n) / sum(n), 9) AS purity FROM ct GROUP BY cluster
""")
def q_kmeans_purity_fixed(spark, sf_dir):
    """E6 + A13: composition of the fixed-centroid clusters by label, purity."""
    e = _emb(spark, sf_dir)
    comp = km.composition(e, "embedding", "label", _label_starts(e))
    p = st.purity(comp)
    return p.select("cluster", "size", F.round("purity", 9).alias("purity"))


@query("kmeans_loop")
def q_kmeans_loop(spark, sf_dir):
    """L13 + G4 + E6: k-means by rounds of aggregation from k=10 seeded sample
    rows; final centroids' cluster sizes and purity."""
    e = _emb(spark, sf_dir)
    start = km.collect_vectors(sp.sample_k(e, "vec_id", 10, seed=0), "embedding", 10)
    res = km.fit(e, "embedding", start, max_iter=50, tol=1e-6)
    return st.purity(km.composition(e, "embedding", "label", res.centroids))


@query("kmeans_ml")
def q_kmeans_ml(spark, sf_dir):
    """Library k-means (k=10, k-means|| start with 8 steps, tol 1e-6,
    seed 0); composition and purity of its clusters."""
    e = _emb(spark, sf_dir).withColumn("features", array_to_vector(F.col("embedding").cast("array<double>")))
    model = KMeans(k=10, maxIter=50, initMode="k-means||", initSteps=8, tol=1e-6, seed=0).fit(e)
    pred = model.transform(e).select(F.col("prediction").alias("cluster"), "label")
    return st.purity(st.count_by(pred, ["cluster", "label"]))


@query("softmax_temperature", sql="""
WITH s AS (SELECT vec_id, list_transform(embedding, lambda v: v::DOUBLE) AS a FROM embeddings),
e AS (SELECT vec_id, list_transform(a, lambda v: exp((v - list_max(a)) / 0.5)) AS ex FROM s)
SELECT vec_id, list_transform(ex, lambda v: round(v / list_sum(ex), 6)) AS probs FROM e
""")
def q_softmax(spark, sf_dir):
    """Softmax of all dims as scores, temperature 0.5."""
    e = _emb(spark, sf_dir)
    return e.select("vec_id", _round_arr(softmax(F.col("embedding"), 0.5)).alias("probs"))


@query("argmax_class", sql="""
SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::INTEGER AS cls
FROM embeddings
""")
def q_argmax(spark, sf_dir):
    """Index of the first maximum of all dims."""
    e = _emb(spark, sf_dir)
    return e.select("vec_id", argmax(F.col("embedding")).alias("cls"))


@query("scale_array", sql="""
SELECT vec_id, list_transform(embedding, lambda v: round(v::DOUBLE / 255.0, 9)) AS scaled FROM embeddings
""")
def q_scale_array(spark, sf_dir):
    """Every element divided by 255."""
    e = _emb(spark, sf_dir)
    s = scale_array(F.col("embedding").cast("array<double>"), 1.0 / 255.0)
    return e.select("vec_id", F.transform(s, lambda v: F.round(v, 9)).alias("scaled"))


@query("sample_category", sql="""
WITH s AS (SELECT vec_id, list_transform(embedding, lambda v: v::DOUBLE) AS a FROM embeddings),
g AS (SELECT vec_id, list_transform(range(1, len(a) + 1), lambda i:
        a[i] / 1.0 - ln(-ln((('0x' || substr(md5('3:' || vec_id::varchar || ':' || (i - 1)::varchar), 1, 8))::UBIGINT
                              + 0.5) / 4294967296.0))) AS gv FROM s)
SELECT vec_id, (list_position(gv, list_max(gv)) - 1)::INTEGER AS draw FROM g
""")
def q_sample_category(spark, sf_dir):
    """One category per row drawn from softmax(all dims) by the
    Gumbel-max rule, with reproducible hash uniforms."""
    e = _emb(spark, sf_dir)
    return e.select("vec_id", sample_category(F.col("embedding"), F.col("vec_id"),
                                              seed=3).alias("draw"))


@query("quantiles_per_class", sql="""
WITH v AS (SELECT label, unnest(range(len(embedding)))::INTEGER AS j, unnest(embedding)::DOUBLE AS x FROM embeddings),
r AS (SELECT label, j, x, row_number() OVER (PARTITION BY label, j ORDER BY x) AS rk,
             count(*) OVER (PARTITION BY label, j) AS n FROM v WHERE isfinite(x)),
p AS (SELECT unnest([0.0, 0.125, 0.25, 0.5, 0.75, 0.875, 1.0]::DOUBLE[]) AS prob)
SELECT r.label, r.j, p.prob, r.n, r.x AS value FROM r JOIN p ON r.rk = greatest(1, ceil(p.prob * r.n))
""")
def q_quantiles_per_class(spark, sf_dir):
    """G6 + W6: exact quantiles of every embedding dim in every class, by
    counting value cells over passes (no sort, no ranks)."""
    from kiln.operators.quantiles import exact_quantiles
    e = _emb(spark, sf_dir)
    dims = e.agg(F.max(F.size("embedding")).alias("d")).first().d or 0
    return exact_quantiles(e, "label", [F.get("embedding", F.lit(i)) for i in range(dims)],
                           [0.0, 0.125, 0.25, 0.5, 0.75, 0.875, 1.0])


@query("copula_synth")
def q_copula_synth(spark, sf_dir):
    """G6 + G7: synthetic rows of all embedding dims, as many as the source
    has and 100,000 at least, classes in proportion to the labels, each class
    from its own Gaussian copula with empirical marginals."""
    from kiln.operators.synth import sample_copula
    e = _emb(spark, sf_dir)
    size = e.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("dims")).first()
    names = [f"x{i}" for i in range(size.dims or 0)]
    src = e.select("vec_id", "label", *[F.get("embedding", F.lit(i)).cast("double").alias(x) for i, x in enumerate(names)])
    return sample_copula(src, "vec_id", "label", names, max(N_SYNTH, size.n), seed=0)
