"""Exact k-nearest neighbours (J5) and Borderline-SMOTE.

No pairwise join of whole tables. Reference points are first collapsed into
(location, class) groups with a weight, so exact duplicates -- even a third
of all rows at one point -- are one group. Up to ``MAX_DIMS`` dimensions the
search goes through the boxes of ``boxes.py``, beyond through the pivot cells
of ``cells.py``: both meet a query only with the cells that may hold one of
its neighbours, without a cap on candidates.

Ties at equal distance are broken by class (the ``first_class`` first, then
the rest) and then by the group's smallest id; units inside a group are
interchangeable.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.operators import boxes, cells
from kiln.operators.split import id_rank
from kiln.session import materialize

MAX_DIMS = 8


def knn(queries: DataFrame, refs: DataFrame, id_col: str, vec: str, label: str, k: int,
        first_class=None, exclude_self: bool = True, max_cell_groups: int = 4096) -> DataFrame:
    """For each query (id_col, vec[, label]) the k nearest reference units,
    excluding the query itself when ``exclude_self`` (the query must then be a
    reference row with the same id). Output rows: (qid, n_vec, n_label, take,
    d2) with ``sum(take) = min(k, available)`` per query."""
    first = queries.select(F.size(vec)).first()
    if first is not None and (first[0] or 0) > MAX_DIMS:    # a box's bound says little there
        hits, _ = cells.knn(queries, refs, id_col, vec, label, k, first_class, exclude_self)
        return hits.select("qid", "n_vec", "n_label", "take", "d2")
    return boxes.knn(queries, refs, id_col, vec, label, k, first_class, exclude_self, max_cell_groups)


def danger_points(train: DataFrame, id_col: str, vec: str, label: str, minority, majority,
                  m: int = 5) -> DataFrame:
    """Borderline-SMOTE step 1: minority rows whose ``m`` nearest neighbours
    (all classes, itself excluded) hold a majority count in ``[m/2, m)``.
    Output: (id, vec, n_majority, danger)."""
    train = materialize(train.select(id_col, vec, label), "smote-train")
    mino = train.where(F.col(label) == F.lit(minority))
    nn = knn(mino, train, id_col, vec, label, m, first_class=majority)
    counts = nn.groupBy("qid").agg(F.sum(F.when(F.col("n_label") == F.lit(majority), F.col("take"))
                                         .otherwise(0)).alias("n_majority"))
    return (mino.join(counts.withColumnRenamed("qid", id_col).hint("merge"), id_col, "left")
            .withColumn("n_majority", F.coalesce("n_majority", F.lit(0)).cast("bigint"))
            .withColumn("danger", (F.col("n_majority") >= F.lit(m / 2.0)) & (F.col("n_majority") < F.lit(m)))
            .select(id_col, vec, "n_majority", "danger"))


def _uniform(seed: int, *cols):
    h = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in cols])), 1, 8), 16, 10)
    return (h.cast("double") + F.lit(0.5)) / F.lit(4294967296.0)


def borderline_smote(train: DataFrame, id_col: str, vec: str, label: str, minority, majority,
                     k: int = 2, m: int = 5, seed: int = 0) -> DataFrame:
    """Synthetic minority rows until both classes have the same size:
    each new row picks a danger point (uniform), one of its ``k`` nearest
    minority neighbours (uniform) and a gap ``u`` in [0, 1):
    ``x + u * (neighbour - x)``. All draws are md5 uniforms of (seed, row),
    so reruns agree. Returns the synthetic rows (id = -1 - row index)."""
    spark = train.sparkSession
    train = train.select(id_col, vec, label).persist(StorageLevel.MEMORY_AND_DISK)
    sizes = {r[0]: r[1] for r in train.groupBy(label).count().collect()}   # k classes
    n_new = int(sizes.get(majority, 0) - sizes.get(minority, 0))
    dang = danger_points(train, id_col, vec, label, minority, majority, m).where("danger")
    dang = id_rank(dang, id_col, size_col=None).withColumn("_dix", F.col("_rank") - 1).drop("_rank")
    dang = dang.persist(StorageLevel.MEMORY_AND_DISK)
    n_d = dang.count()
    schema = f"{id_col} long, {label} int, {vec} array<double>"
    if n_new <= 0 or n_d == 0:
        dang.unpersist()
        return spark.createDataFrame([], schema)
    mino = train.where(F.col(label) == F.lit(minority)).select(id_col, vec, label)
    nn = knn(dang.select(id_col, vec, F.lit(minority).alias(label)), mino, id_col, vec, label, k)
    units = nn.select("qid", F.explode(F.array_repeat(F.col("n_vec"), F.col("take").cast("int"))).alias("nv"))
    neigh = units.groupBy("qid").agg(F.collect_list("nv").alias("_nbrs"))   # at most k per point
    table = dang.join(neigh.withColumnRenamed("qid", id_col), id_col).select("_dix", F.col(vec).alias("_x"), "_nbrs")
    s = spark.range(n_new).withColumnRenamed("id", "_s")
    s = s.withColumn("_dix", F.floor(_uniform(seed, F.col("_s"), F.lit("p")) * F.lit(n_d)).cast("bigint"))
    # n_d rows, counted above: broadcast when small, else a shuffle join whose
    # keys are hit uniformly (n_new / n_d rows each)
    table = F.broadcast(table) if n_d <= 1_000_000 else table
    j = s.join(table, "_dix")
    pick = F.element_at(F.col("_nbrs"), (F.floor(_uniform(seed, F.col("_s"), F.lit("n")) * F.size("_nbrs")) + 1).cast("int"))
    gap = _uniform(seed, F.col("_s"), F.lit("g"))
    new = F.zip_with(F.col("_x"), pick, lambda a, b: a + gap * (b - a))
    return j.select((F.lit(-1) - F.col("_s")).alias(id_col), F.lit(minority).cast("int").alias(label),
                    new.alias(vec))
