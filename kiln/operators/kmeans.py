"""k-means as DataFrame plans.

The nearest centroid is an array expression over the k centroids, which
reach every row as one broadcast value (a one-row table, size checked):
every row computes k distances in the JVM -- no pairwise join, no shuffle,
nothing per row in Python. A round is one hash
aggregate (per cluster: count and per-dimension sums, with a partial phase,
so a cluster holding a third of all rows costs one row per task). The
driver keeps only the k x d centroid state between rounds.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.functions.arrays import squared_distance

MAX_CENTROID_CELLS = 5_000_000  # k * d bound for the broadcast centroid row


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def nearest_of(vec: Column | str, cents: Column | str) -> Column:
    """J2 / L15 over an ``array<array<double>>`` column of centroids: id of the
    nearest by squared Euclidean distance, ties to the lowest id (the first
    strictly smaller distance wins); null when the distances are NaN."""
    v = _c(vec).cast("array<double>")
    cands = F.transform(_c(cents), lambda c, j: F.struct(squared_distance(v, c).alias("d"),
                                                          j.alias("cid")))
    best = F.array_min(cands)
    return F.when(~F.isnan(best["d"]) & best["d"].isNotNull(), best["cid"])


def with_centroids(df: DataFrame, centroids: Sequence[Sequence[float]],
                   col: str = "_cents") -> DataFrame:
    """Attach the k centroids to every row as one constant ``array<array<double>>``
    value (size checked: k*d values). A constant array is kept out of the
    generated code, so an iterative loop compiles the same code each round."""
    cells = sum(len(c) for c in centroids)
    if cells > MAX_CENTROID_CELLS:
        raise ValueError(f"k*d = {cells} centroid values exceed {MAX_CENTROID_CELLS}")
    value = F.lit([[float(v) for v in c] for c in centroids]).cast("array<array<double>>")
    return df.withColumn(col, value)


def nearest(vec: Column | str, centroids: Sequence[Sequence[float]]) -> Column:
    """Nearest-centroid id against literal centroids (for a few fixed centres
    in a one-off expression; use ``assign`` for data-sized work)."""
    lits = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centroids])
    return nearest_of(vec, lits)


def _with_best(df: DataFrame, vec: str, centroids: Sequence[Sequence[float]],
               keep: Sequence[Column]) -> DataFrame:
    """Rows of ``df`` with ``_best`` = struct(d, cid) of the nearest centroid,
    computed once per row."""
    v = F.col(vec).cast("array<double>")
    best = F.array_min(F.transform(F.col("_cents"), lambda c, j: F.struct(
        squared_distance(v, c).alias("d"), j.alias("cid"))))
    return with_centroids(df, centroids).select(*keep, best.alias("_best"))


def _cluster_of(best: str = "_best") -> Column:
    b = F.col(best)
    return F.when(~F.isnan(b["d"]) & b["d"].isNotNull(), b["cid"])


def assign(df: DataFrame, vec: str, centroids: Sequence[Sequence[float]],
           out: str = "cluster") -> DataFrame:
    return _with_best(df, vec, centroids, [F.col(c) for c in df.columns]) \
        .withColumn(out, _cluster_of()).drop("_best")


def cluster_stats(df: DataFrame, vec: str, centroids: Sequence[Sequence[float]], d: int) -> DataFrame:
    """Per cluster, row count, mean vector and within-cluster sum of
    squared distances -- one aggregate over one scan. The mean is the
    ``Summarizer`` vector aggregate (one expression, with a partial phase),
    not d separate aggregates."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    a = _with_best(df, vec, centroids,
                   [array_to_vector(F.col(vec).cast("array<double>")).alias("_v")]) \
        .select(_cluster_of().alias("cluster"), "_v", F.col("_best.d").alias("_d2"))
    return a.where(F.col("cluster").isNotNull()).groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"),
        vector_to_array(Summarizer.mean(F.col("_v"))).alias("centroid"),
        F.sum("_d2").alias("sse"))


@dataclass
class KMeansResult:
    centroids: list[list[float]]
    counts: dict[int, int]
    rounds: int
    movement: list[float] = field(default_factory=list)
    sse: list[float] = field(default_factory=list)


def fit(df: DataFrame, vec: str, start: Sequence[Sequence[float]], max_iter: int = 50,
        tol: float = 1e-6, change_tol: float = 1e-12, patience: int | None = None,
        min_delta: float = 0.0) -> KMeansResult:
    """Lloyd rounds from ``start``. Stops when the summed centroid
    movement is <= ``tol``, or changes by <= ``change_tol`` from the previous
    round, or after ``max_iter`` rounds. An empty cluster keeps its centroid.
    C2: with ``patience``, also stops when the within-cluster SSE has not
    improved by more than ``min_delta`` for ``patience`` rounds, and returns
    the best state seen. Features are persisted (memory, spilling to disk)
    for the loop and released after it."""
    d = len(start[0])
    feats = df.select(F.col(vec).cast("array<double>").alias(vec)).where(
        F.col(vec).isNotNull()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        cents = [list(map(float, c)) for c in start]
        prev_move = math.inf
        moves, sses = [], []
        best = (math.inf, cents, {})
        stale = 0
        counts: dict[int, int] = {}
        it = 0
        for it in range(1, max_iter + 1):
            rows = cluster_stats(feats, vec, cents, d).collect()  # k rows
            by_id = {r["cluster"]: r for r in rows}
            new = [list(by_id[j]["centroid"]) if j in by_id else cents[j] for j in range(len(cents))]
            counts = {j: int(by_id[j]["n"]) if j in by_id else 0 for j in range(len(cents))}
            sse = float(sum(r["sse"] for r in rows))
            move = sum(math.dist(a, b) for a, b in zip(new, cents))
            moves.append(move)
            sses.append(sse)
            if sse < best[0] - min_delta:
                best, stale = (sse, cents, counts), 0
            else:
                stale += 1
            cents = new
            if move <= tol or abs(prev_move - move) <= change_tol:
                break
            if patience is not None and stale >= patience:
                cents, counts = best[1], best[2]
                break
            prev_move = move
        return KMeansResult(cents, counts, it, moves, sses)
    finally:
        feats.unpersist()


def composition(df: DataFrame, vec: str, label: str, centroids: Sequence[Sequence[float]]) -> DataFrame:
    """(cluster, label, n) cross tab of the final assignment."""
    return (assign(df, vec, centroids).select("cluster", F.col(label).alias("label"))
            .groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n")))


def hash_uniform(seed: int, draw: str, key: Column) -> Column:
    """A uniform in (0, 1) from the md5 of (seed, draw, key)."""
    h = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(f"{seed}:{draw}"), key.cast("string")).cast("binary")), 1, 8), 16, 10)
    return (h.cast("double") + 0.5) / 4294967296.0


def _blocked_nearest(df: DataFrame, keep: Sequence[str], vec: str, centers: np.ndarray) -> DataFrame:
    """``keep`` columns, squared distance ``d2`` to the nearest of ``centers``
    and its index ``near`` (lowest on ties), in Arrow batches; rows without a
    vector get nulls."""
    held = df.sparkSession.sparkContext.broadcast(centers)
    kinds = dict(df.dtypes)

    def step(batches):
        c = held.value
        for batch in batches:
            col = batch.column(vec).cast(pa.list_(pa.float64()))
            there = np.asarray(col.is_valid())
            x = col.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(-1, c.shape[1])
            best, near = np.full(len(x), np.inf), np.zeros(len(x), np.int64)
            for j, center in enumerate(c):
                diff = x - center
                d2 = np.einsum("ij,ij->i", diff, diff)
                less = d2 < best
                best[less], near[less] = d2[less], j
            full, at = np.full(len(col), np.nan), np.zeros(len(col), np.int64)
            full[there], at[there] = best, near
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in keep] + [pa.array(full, mask=~there), pa.array(at, mask=~there)], [*keep, "d2", "near"])

    spec = ", ".join(f"`{k}` {kinds[k]}" for k in keep)
    return df.select(*dict.fromkeys([*keep, vec])).mapInArrow(step, f"{spec}, d2 double, near long")


MAX_CANDIDATES = 100_000


def parallel_start(df: DataFrame, id_col: str, vec: str, k: int, steps: int = 8, oversample: float = 2.0,
                   seed: int = 0) -> list[list[float]]:
    """k-means|| start: from the row with the smallest hash uniform, every
    step draws each row with probability min(1, oversample * k * d2 / cost) by
    a hash uniform of its id, where d2 is its squared distance to the nearest
    centre drawn so far. The candidates (about oversample * k a step, checked)
    are weighted by the rows nearest to them and reduced to ``k`` on the
    driver by weighted distance draws, also by hash uniforms: the same start
    at every run and for every partitioning. Ids must be unique; rows with a
    null id or vector are not drawn. With fewer distinct candidates than
    ``k``, all of them are returned.

    Every step is one pass over the rows; only rows of the step's draw leave
    the tasks."""
    rows = df.where(F.col(id_col).isNotNull() & F.col(vec).isNotNull()).select(id_col, F.col(vec).cast("array<double>").alias(vec)) \
        .persist(StorageLevel.MEMORY_AND_DISK)
    try:
        first = rows.select(hash_uniform(seed, "first", F.col(id_col)).alias("u"), id_col, vec).orderBy("u", id_col).limit(1).collect()
        if not first:
            return []
        picked = [(first[0][id_col], first[0][vec])]
        for step in range(steps):
            scored = _blocked_nearest(rows, [id_col, vec], vec, np.array([c for _, c in picked]))
            cost = scored.agg(F.sum("d2").alias("s")).first()["s"]
            if not cost:
                break
            hit = hash_uniform(seed, f"step{step}", F.col(id_col)) < oversample * k * F.col("d2") / F.lit(float(cost))
            drawn = scored.where(hit).select(id_col, vec).limit(MAX_CANDIDATES + 1).collect()
            if len(picked) + len(drawn) > MAX_CANDIDATES:
                raise ValueError(f"over {MAX_CANDIDATES} candidates: lower oversample, steps or k")
            picked += sorted((r[id_col], r[vec]) for r in drawn)
        centers = np.array([c for _, c in picked])
        weight = np.zeros(len(centers))
        for r in _blocked_nearest(rows, [id_col], vec, centers).groupBy("near").agg(F.count(F.lit(1)).alias("n")).collect():
            weight[r["near"]] = r["n"]
    finally:
        rows.unpersist()
    return _reduce(centers, weight, k, seed).tolist()


def _reduce(centers: np.ndarray, weight: np.ndarray, k: int, seed: int) -> np.ndarray:
    """``k`` of the weighted candidates: the heaviest first (first on ties),
    then by draws with probability weight * squared distance."""
    import hashlib
    chosen = [int(np.argmax(weight))]
    best = ((centers - centers[chosen[0]]) ** 2).sum(1)
    while len(chosen) < k:
        cum = np.cumsum(weight * best)
        if cum[-1] <= 0:
            break
        u = (int(hashlib.md5(f"{seed}:reduce:{len(chosen)}".encode()).hexdigest()[:8], 16) + 0.5) / 4294967296.0
        chosen.append(int(np.searchsorted(cum, u * cum[-1], side="left")))
        best = np.minimum(best, ((centers - centers[chosen[-1]]) ** 2).sum(1))
    return centers[chosen]


def collect_vectors(df: DataFrame, vec: str, limit: int) -> list[list[float]]:
    """Collect at most ``limit`` vectors (k start centroids): bounded."""
    return [list(map(float, r[0])) for r in df.select(vec).limit(limit).collect()]
