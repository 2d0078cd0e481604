"""Exact top-k search by inner product as a Voronoi join.

Pivots (rows of the data, a bounded sample by hash) cut the space into cells.
Data rows go to the cell of their nearest pivot, queries to the nearest of
the first few pivots, which makes query groups. A cell is summed up by its
rows' extent along the pivot and away from it. For a query q and a cell with
pivot p, every row s = a * p/|p| + rest of the cell has

    <q, s>  <=  max(a_q * a_min, a_q * a_max) + |q - a_q p/|p|| * max |rest|

Each group first meets its own pivot's cell, which gives every query a lower
bound of its k-th best score. Then a query goes on to a cell only if the
bound above reaches that score, and a row of the cell is copied to a query
group only if <p_g, s> + radius_g * |s| reaches the group's least bound.
Copies meet in bounded pieces (at most about ``GROUP_ROWS`` queries and
``CELL_ROWS`` rows of one cell), each solved by one exact matrix product.
Where the data has no structure (random directions) the bounds prune little
and every piece is visited: the result is the same, the work that of blocks
of queries against all rows.

Exactness: vectors are integers; scores are computed without rounding. Of
equal vectors only the k + 1 with the smallest ids can be among the k best,
so a vector held by a third of all rows is cut to k + 1 copies while it is
shuffled (rows are ranked inside each map task first), and equal query
vectors are solved once.

Defined results: vectors null or with null or non-finite components take no
part; shorter vectors count as padded with zeros; components beyond the long
range and scores beyond it are set to its ends (and tie there);
rows are rows, so of two rows with one id each is a candidate for the other;
a null id is never a query and comes last among ties. An empty table gives
an empty result. Other columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.session import materialize

K = 5
MAX_PIVOTS = 1024
CELL_ROWS = 4096
GROUP_ROWS = 512
SCALE = 256
TILE = 1 << 21          # scores held at once while solving a piece
RESULT = "query_id long, rank int, vec_id long, score long"
_LONG = np.iinfo(np.int64)


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component as long; null for vectors that
    are null or hold a null or non-finite component."""
    bad = F.exists(vector, lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True)))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))))


def matrix(col: pa.Array, width: int) -> np.ndarray:
    """Rows of an Arrow list column as an int64 matrix, zero-padded."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.asarray(col.value_lengths()).astype(np.int64)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: float64 where every sum stays
    below 2^53, else Python integers, set to the ends of the long range."""
    top = [float(np.abs(x.astype(np.float64)).max(initial=0)) for x in (a, b)]
    if top[0] * top[1] * max(1, a.shape[1]) < 2.0 ** 52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object).dot(b.astype(object).T)
    return np.clip(exact, _LONG.min, _LONG.max).astype(np.int64)


def nearest(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Index of the nearest pivot (first on ties)."""
    f = v.astype(np.float64)
    return ((pivots ** 2).sum(1)[None, :] - 2 * f @ pivots.T).argmin(1)


def extent(v: np.ndarray, pivot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(component along the pivot's direction, length of the rest) of each
    row; ``pivot`` is one row per row of ``v``, or a single one."""
    f = v.astype(np.float64)
    size = np.sqrt((pivot ** 2).sum(-1, keepdims=True))
    unit = np.divide(pivot, size, out=np.zeros_like(pivot), where=size > 0)
    along = (f * unit).sum(-1)
    rest = np.sqrt(np.maximum((f ** 2).sum(-1) - along ** 2, 0))
    return along, rest


def slack(a: np.ndarray | float, b: np.ndarray | float) -> np.ndarray | float:
    """Room for rounding in a bound made of products of lengths a and b."""
    return 0.5 + 1e-9 * a * b


def upper(q: np.ndarray, pivots: np.ndarray, low: np.ndarray, high: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Upper bounds of <q, s> over the rows s of every cell: queries x cells."""
    f = q.astype(np.float64)
    size = np.sqrt((pivots ** 2).sum(1))
    unit = np.divide(pivots, size[:, None], out=np.zeros_like(pivots), where=size[:, None] > 0)
    along = f @ unit.T
    norm = np.sqrt((f ** 2).sum(1))[:, None]
    across = np.sqrt(np.maximum(norm ** 2 - along ** 2, 0))
    far = np.maximum(np.maximum(np.abs(low), np.abs(high)), rest)[None, :]
    return np.maximum(along * low, along * high) + across * rest + slack(norm, far)


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Per row of ``scores`` the columns of its k best (all, when fewer), in
    order: score descending, then column ascending."""
    out = np.empty((len(scores), min(k, scores.shape[1])), np.int64)
    for i, row in enumerate(scores):
        cols = np.arange(len(row))
        if len(row) > k:
            cols = np.flatnonzero(row >= np.partition(row, len(row) - k)[len(row) - k])
        out[i] = cols[np.lexsort((cols, ~row[cols]))][:k]
    return out


def _places(pivots, width: int):
    """Arrow step: every row's cell and its extent against the cell's pivot."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pivots.value
        for batch in batches:
            v = matrix(batch.column("v"), width)
            cell = nearest(v, p)
            along, rest = extent(v, p[cell]) if len(v) else (np.zeros(0), np.zeros(0))
            f = v.astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(along), pa.array(rest),
                 pa.array(np.sqrt((f ** 2).sum(1))), pa.array(np.sqrt(((f - p[cell]) ** 2).sum(1)))],
                [*batch.schema.names, "cell", "along", "rest", "norm", "away"])
    return step


def _solver(width: int, k: int):
    """One piece: its queries against its rows, the k best of each. ``twin``
    marks a row whose vector is the query's own."""
    def solve(piece: pa.Table) -> pa.Table:
        asked = piece.column("is_query").combine_chunks()
        q = piece.filter(asked)
        s = piece.filter(pc.invert(asked)).sort_by([("vec_id", "ascending")])     # nulls last
        row = col = score = np.zeros(0, np.int64)
        twin = np.zeros(0, bool)
        if len(q) and len(s):
            sv, qv = matrix(s.column("v"), width), matrix(q.column("v"), width)
            tile, found = max(1, TILE // len(s)), []
            for at in range(0, len(q), tile):
                block = inner(qv[at:at + tile], sv)
                cols = best(block, k)
                found.append((cols, np.take_along_axis(block, cols, 1)))
            col, score = (np.concatenate([x[i] for x in found]).ravel() for i in (0, 1))
            row = np.repeat(np.arange(len(q)), len(col) // len(q))
            twin = (qv[row] == sv[col]).all(1)
        return pa.table({"key": q.column("key").take(pa.array(row)), "vec_id": s.column("vec_id").take(pa.array(col)),
                         "score": pa.array(score), "twin": pa.array(twin)})
    return solve


def _meet(queries: DataFrame, data: DataFrame, width: int, k: int) -> DataFrame:
    """Solve the pieces: queries (key, v, piece columns) and the rows copied
    to them (vec_id, v, piece columns)."""
    piece = ["grp", "part", "cell", "slice"]
    both = queries.select(*piece, F.lit(True).alias("is_query"), "key", F.lit(None).cast("long").alias("vec_id"), "v") \
        .unionByName(data.select(*piece, F.lit(False).alias("is_query"), F.lit(None).cast("string").alias("key"), "vec_id", "v"))
    return both.groupBy(*piece).applyInArrow(_solver(width, k), "key string, vec_id long, score long, twin boolean")


def _pick(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of every key, with their place."""
    w = Window.partitionBy("key").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = K, max_pivots: int = MAX_PIVOTS,
          cell_rows: int = CELL_ROWS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """For each row of ``vectors`` (vec_id long, v array<long>) where
    ``is_query`` holds, the ``k`` other rows with the highest inner products:
    (query_id, rank from 1, vec_id, score), ties to the smaller vec_id."""
    spark = vectors.sparkSession
    rows = materialize(vectors.select("vec_id", "v").where("v is not null"), "knn-rows")
    asked = materialize(rows.where(is_query & F.col("vec_id").isNotNull())
                        .withColumn("key", F.md5(F.concat_ws(",", "v").cast("binary"))), "knn-queries")
    classes = asked.groupBy("key").agg(F.first("v").alias("v"))
    copies = Window.partitionBy("v").orderBy(F.col("vec_id").asc_nulls_last())
    data = rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1)

    of = data.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("v")), F.lit(0)).alias("width")).first()
    n_queries = classes.count()
    if not of["n"] or not n_queries:
        return spark.createDataFrame([], RESULT)
    width = max(1, of["width"])
    m = max(1, min(max_pivots, -(-of["n"] // cell_rows)))
    picked = data.where("copy = 1").select("v").withColumn("h", F.md5(F.concat_ws(",", F.lit("pivot"), "v").cast("binary"))) \
        .orderBy("h").limit(m).collect()
    pivots = matrix(pa.array([r["v"] for r in picked], pa.list_(pa.int64())), width).astype(np.float64)
    m = len(pivots)
    g = max(1, min(m, -(-n_queries // group_rows)))
    shared, shared_g = spark.sparkContext.broadcast(pivots), spark.sparkContext.broadcast(pivots[:g])
    placed = "cell int, along double, rest double, norm double, away double"
    data = materialize(data.select("vec_id", "v").mapInArrow(_places(shared, width), f"vec_id long, v array<bigint>, {placed}"), "knn-cells")
    groups = materialize(classes.select("key", "v").mapInArrow(_places(shared_g, width), f"key string, v array<bigint>, {placed}")
                         .withColumnRenamed("cell", "grp"), "knn-groups")

    # summaries: one row a cell and one a group, bounded by the pivots
    cells = {r["cell"]: r for r in data.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.min("along").alias("low"), F.max("along").alias("high"), F.max("rest").alias("rest")).collect()}
    members = {r["grp"]: r for r in groups.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")).collect()}
    n_slices = {c: -(-r["n"] // cell_rows) for c, r in cells.items()}
    n_parts = {c: -(-r["n"] // group_rows) for c, r in members.items()}
    counts = F.create_map(*[F.lit(int(x)) for c, n in n_slices.items() for x in (c, n)])
    parts = F.create_map(*[F.lit(int(x)) for c, n in n_parts.items() for x in (c, n)])
    data = data.withColumn("slice", F.pmod(F.xxhash64("vec_id", "v"), counts[F.col("cell")]).cast("int"))
    groups = groups.withColumn("part", F.pmod(F.xxhash64("key"), parts[F.col("grp")]).cast("int"))

    # every group against its own pivot's cell
    home_q = groups.withColumn("cell", F.col("grp")).withColumn("slice", F.explode(F.sequence(F.lit(0), F.coalesce(counts[F.col("cell")], F.lit(1)) - 1)))
    home_d = data.where(F.col("cell") < g).withColumn("grp", F.col("cell")) \
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce(parts[F.col("grp")], F.lit(1)) - 1)))
    found = materialize(_pick(_meet(home_q, home_d, width, k + 1), k + 1), "knn-home")
    if m == 1:
        return _expand(asked, found, k)

    # the (k + 1)-th score so far is a lower bound of the final one
    floor = found.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")) \
        .where((F.col("n") == k + 1) & (F.col("least") > int(_LONG.min)))
    groups = groups.join(floor.select("key", "least"), "key", "left")
    table = [cells.get(c) for c in range(m)]
    low, high, rest = (np.array([r[x] if r else 0.0 for r in table]) for x in ("low", "high", "rest"))
    there = np.array([r is not None for r in table])
    summary = spark.sparkContext.broadcast((pivots, low, high, rest, there))

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A query's cells other than its own that may hold better rows."""
        p, lo, hi, re, full = summary.value
        for batch in batches:
            v = matrix(batch.column("v"), width)
            least = batch.column("least").to_numpy(zero_copy_only=False).astype(np.float64)     # null: nan
            want = ~(upper(v, p, lo, hi, re) < least[:, None]) & full
            want[np.arange(len(v)), np.asarray(batch.column("grp"))] = False
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([np.flatnonzero(w).astype(np.int32) for w in want], pa.list_(pa.int32()))],
                [*batch.schema.names, "cells"])

    routed = materialize(groups.select("key", "v", "grp", "part", "least").mapInArrow(
        reach, "key string, v array<bigint>, grp int, part int, least long, cells array<int>"), "knn-routes")
    wanted = np.zeros((m, g), bool)                     # cells x groups, bounded by the pivots
    for r in routed.select("grp", F.explode("cells").alias("cell")).distinct().collect():
        wanted[r["cell"], r["grp"]] = True
    if not wanted.any():
        return _expand(asked, found, k)
    least = np.full(g, -np.inf)
    for r in routed.groupBy("grp").agg(F.min("least").alias("least"), F.count("least").alias("known"), F.count(F.lit(1)).alias("n")).collect():
        if r["known"] == r["n"]:
            least[r["grp"]] = r["least"]
    radius = np.array([members[c]["radius"] if c in members else 0.0 for c in range(g)])
    plan = spark.sparkContext.broadcast((pivots[:g], radius, least, wanted))

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The groups that a row has to be copied to."""
        p, rad, floor_, want = plan.value
        for batch in batches:
            f = matrix(batch.column("v"), width).astype(np.float64)
            norm = np.sqrt((f ** 2).sum(1))[:, None]
            far = (np.sqrt((p ** 2).sum(1)) + rad)[None, :]
            go = want[np.asarray(batch.column("cell"))] & ~(f @ p.T + norm * rad[None, :] + slack(norm, far) < floor_[None, :])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([np.flatnonzero(x).astype(np.int32) for x in go], pa.list_(pa.int32()))],
                [*batch.schema.names, "grps"])

    out_q = routed.withColumn("cell", F.explode("cells")) \
        .withColumn("slice", F.explode(F.sequence(F.lit(0), counts[F.col("cell")] - 1)))
    out_d = data.select("vec_id", "v", "cell", "slice").mapInArrow(copy, "vec_id long, v array<bigint>, cell int, slice int, grps array<int>") \
        .withColumn("grp", F.explode("grps")).withColumn("part", F.explode(F.sequence(F.lit(0), parts[F.col("grp")] - 1)))
    more = _meet(out_q, out_d, width, k + 1)
    return _expand(asked, _pick(found.drop("place").unionByName(more), k + 1), k)


def _expand(asked: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """Results of the distinct query vectors for every query row, less the
    row itself: the first hit with its id and its vector."""
    ranked = found.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score", "twin"))).alias("hits"))
    hit = asked.select(F.col("vec_id").alias("query_id"), "key").join(ranked, "key")
    is_own = F.transform("hits", lambda h: h["twin"] & F.coalesce(h["vec_id"] == F.col("query_id"), F.lit(False)))
    others = F.filter("hits", lambda h: h["place"] != F.col("own"))
    return hit.withColumn("own", F.array_position(is_own, True)) \
        .select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "h")) \
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("h.vec_id").alias("vec_id"), F.col("h.score").alias("score"))


def embedding_neighbours(embeddings: DataFrame, every: int = 50, k: int = K) -> DataFrame:
    """The query set is the rows whose vec_id is divisible by ``every``."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding")).alias("v"))
    return top_k(rows, F.col("vec_id") % every == 0, k)
