"""Exact k nearest neighbours in any number of dimensions.

Reference points are collapsed into (location, class) groups with a weight and
cut into cells around pivots (a sample by digest, bounded); a crowded cell is
split into pieces of bounded size. A cell is described by the least and
greatest distance of its groups to its pivot. For a query at distance D from
the pivot no point of the cell is nearer than max(D - greatest, least - D, 0).

Queries visit cells best first, in rounds that take twice as many cells each
time: a round meets, for every open query, the cells with the next smallest
bounds. A query is settled once it holds k units and the bound of its next
cell exceeds its k-th distance, so most settle after a few cells and none
misses a neighbour. Within a met cell a group is skipped by the same triangle
inequality on its own distance to the pivot before its full distance is
computed.

A round is one grouped step on (cell, piece, block of queries) keys of bounded
size; the driver holds only the pivots and one row per cell."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.session import materialize

MAX_PIVOTS = 1024
CELL_POINTS = 2048
QUERY_BLOCK = 256
SLICE_VALUES = 1 << 20        # distances, or components of visits, that a task holds at a time


def _matrix(col: pa.Array, width: int) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), width)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances by differences (no cancellation): rows of a x rows of b."""
    out = np.empty((len(a), len(b)))
    for i, row in enumerate(a):
        diff = b - row
        out[i] = np.sqrt(np.einsum("ij,ij->i", diff, diff))
    return out


def usable(vec: str) -> Column:
    """Whether a vector is there, not empty, and all its components finite."""
    v = F.col(vec).cast("array<double>")
    bad = F.exists(v, lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True)))
    return F.coalesce((F.size(v) > 0) & ~bad, F.lit(False))


def weighted_groups(points: DataFrame, id_col: str, vec: str, label: str) -> DataFrame:
    """(v, n_label, w, gid): one row per distinct location and class."""
    return points.where(usable(vec)).groupBy(F.col(vec).cast("array<double>").alias("v"), F.col(label).alias("n_label")).agg(
        F.count(F.lit(1)).alias("w"), F.min(id_col).alias("gid"))


def _slices(batch: pa.RecordBatch, wide: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose rows times ``wide`` values stay bounded."""
    rows = max(1, SLICE_VALUES // max(1, wide))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


class _Cells:
    """What is known of the cells: pivots and their distance ranges. Sent to
    the tasks, bounded by the number of pivots."""

    def __init__(self, pivots: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        self.pivots, self.low, self.high = pivots, low, high

    def bounds(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(distance to every pivot, least distance to any point of its
        cell; infinite where the cell is empty)."""
        d = distances(v, self.pivots)
        least = np.maximum(np.maximum(d - self.high, self.low - d), 0) * (1 - 1e-9)
        least[:, ~np.isfinite(self.low)] = np.inf
        return d, least


def _sample(groups: DataFrame, n: int) -> np.ndarray:
    """``n`` locations in the order of their digests (fewer, if fewer)."""
    rows = groups.select("v").distinct().orderBy(F.md5(F.col("v").cast("string").cast("binary")), "v").limit(n).collect()
    return np.array([r["v"] for r in rows], np.float64)


def knn(queries: DataFrame, refs: DataFrame, id_col: str, vec: str, label: str, k: int, first_class=None,
        exclude_self: bool = True, max_pivots: int = MAX_PIVOTS, cell_points: int = CELL_POINTS,
        first_cells: int = 2) -> tuple[DataFrame, DataFrame]:
    """For each query (id_col, vec[, label]) the ``k`` nearest reference units,
    less the query itself with ``exclude_self`` (it is then a reference row).

    Returns (hits, cost). Hits: (qid, gid, n_vec, n_label, take, d2), ``take``
    units of the group whose smallest id is gid, with sum(take) = min(k,
    available) per query. Ties at equal distance go to ``first_class``, then to
    the smallest gid; units of a group are interchangeable. Cost: (qid, met),
    the groups whose distance to a query was computed.

    All vectors must have the same length. Points and queries whose vector is
    null, empty or has a null or non-finite component take no part; query ids
    must be unique."""
    spark = queries.sparkSession
    kinds = dict(refs.dtypes)
    hit = f"gid: {kinds[id_col]}, n_label: {kinds[label]}, n_vec: array<double>, units: bigint, d2: double"
    hit_type, q_type = f"struct<{hit}>", f"qid {kinds[id_col]}, v array<double>, q_label {kinds[label]}"
    groups = materialize(weighted_groups(refs, id_col, vec, label), "cells-groups")
    own = F.col(label) if exclude_self else F.lit(None).cast(kinds[label])
    asked = materialize(queries.where(usable(vec)).select(
        F.col(id_col).alias("qid"), F.col(vec).cast("array<double>").alias("v"), own.alias("q_label")), "cells-queries")
    size = groups.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("v")).alias("low"), F.max(F.size("v")).alias("high")).first()
    wide = asked.agg(F.min(F.size("v")).alias("low"), F.max(F.size("v")).alias("high")).first()
    if not size["n"] or wide["low"] is None:
        return (spark.createDataFrame([], f"qid {kinds[id_col]}, {hit.replace('units', 'take').replace(':', '')}")
                .select("qid", "gid", "n_vec", "n_label", "take", "d2"), spark.createDataFrame([], f"qid {kinds[id_col]}, met long"))
    if len({size["low"], size["high"], wide["low"], wide["high"]}) > 1:
        raise ValueError("vectors of several lengths")
    width = size["low"]
    pivots = _sample(groups, max(1, min(max_pivots, -(-size["n"] // cell_points) * 4)))
    held = spark.sparkContext.broadcast(pivots)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in _slices(b, len(held.value))):
            d = distances(_matrix(batch.column("v"), width), held.value)
            cell = d.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell])],
                [*batch.schema.names, "cell", "away"])

    groups = materialize(groups.mapInArrow(
        place, f"v array<double>, n_label {kinds[label]}, w long, gid {kinds[id_col]}, cell int, away double"), "cells-placed")
    cells = {r["cell"]: r for r in groups.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.min("away").alias("low"), F.max("away").alias("high")).collect()}
    n = len(pivots)
    known = spark.sparkContext.broadcast(_Cells(
        pivots, np.array([cells[c]["low"] if c in cells else np.inf for c in range(n)]),
        np.array([cells[c]["high"] if c in cells else -np.inf for c in range(n)])))
    pieces = F.create_map(*[F.lit(int(x)) for c, r in cells.items() for x in (c, -(-r["n"] // cell_points))])
    groups = groups.withColumn("piece", F.pmod(F.xxhash64("gid", "v", "n_label"), pieces[F.col("cell")]).cast("int"))

    meetings, found, seen, take = [], None, 0, first_cells
    waiting = asked.withColumn("worst", F.lit(None).cast("double"))
    while True:
        low, high = seen, min(n, seen + take)

        def visit(batches: Iterator[pa.RecordBatch], low=low, high=high) -> Iterator[pa.RecordBatch]:
            """The cells a query meets in this round: those with the next
            smallest bounds, unless its k-th distance is below them."""
            for batch in (s for b in batches for s in _slices(b, n)):
                d, least = known.value.bounds(_matrix(batch.column("v"), width))
                order = np.argsort(least, axis=1, kind="stable")[:, low:high]
                near = np.take_along_axis(least, order, 1)
                worst = batch.column("worst").to_numpy(zero_copy_only=False).astype(np.float64)       # null: nan
                rows, cols = np.nonzero(~(near ** 2 > worst[:, None]) & np.isfinite(near))
                cell = order[rows, cols]
                visit = pa.RecordBatch.from_arrays(
                    [pa.array(rows), pa.array(cell.astype(np.int32)), pa.array(d[rows, cell])], ["row", "cell", "away"])
                for part in _slices(visit, width):                       # a visit repeats its query's vector
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(c).take(part.column("row")) for c in ("qid", "v", "q_label", "worst")] + [part.column("cell"), part.column("away")],
                        ["qid", "v", "q_label", "worst", "cell", "away"])

        visits = waiting.select("qid", "v", "q_label", "worst").mapInArrow(visit, f"{q_type}, worst double, cell int, away double") \
            .withColumn("piece", F.explode(F.sequence(F.lit(0), pieces[F.col("cell")] - 1)))
        met = materialize(_meet(visits, groups, width, k, first_class, exclude_self, f"qid {kinds[id_col]}, met long, hits array<{hit_type}>"), "cells-met")
        meetings.append(met.select("qid", "met"))
        new = met.select("qid", F.explode("hits").alias("h")).select("qid", "h.*")
        found = materialize(_nearest(new if found is None else found.drop("take").unionByName(new), k, first_class), "cells-found")
        seen, take = high, take * 2
        if seen >= n:
            break
        kth = found.groupBy("qid").agg(F.sum("take").alias("got"), F.max("d2").alias("d2"))
        state = waiting.drop("worst").join(kth, "qid", "left").withColumn("worst", F.when(F.col("got") >= k, F.col("d2")))

        def still(batches: Iterator[pa.RecordBatch], at=seen) -> Iterator[pa.RecordBatch]:
            """Queries whose next bound does not exceed their k-th distance."""
            for batch in (s for b in batches for s in _slices(b, n)):
                least = np.sort(known.value.bounds(_matrix(batch.column("v"), width))[1], axis=1)[:, at]
                worst = batch.column("worst").to_numpy(zero_copy_only=False).astype(np.float64)
                yield batch.filter(pa.array(np.isfinite(least) & ~(least ** 2 > worst)))

        waiting = materialize(state.select("qid", "v", "q_label", "worst").mapInArrow(still, f"{q_type}, worst double"), "cells-open")
        if waiting.isEmpty():
            break
    cost = meetings[0]
    for m in meetings[1:]:
        cost = cost.unionByName(m)
    return (found.select("qid", "gid", "n_vec", "n_label", "take", "d2"),
            cost.groupBy("qid").agg(F.sum("met").cast("long").alias("met")))


def _nearest(found: DataFrame, k: int, first_class) -> DataFrame:
    """The nearest ``k`` units of each query among its hits so far."""
    first = F.col("n_label").eqNullSafe(F.lit(first_class)).cast("int") if first_class is not None else F.lit(0)
    w = Window.partitionBy("qid").orderBy(F.col("d2").asc(), first.desc(), F.col("gid").asc(), F.col("n_vec").asc())
    ranked = found.withColumn("at", F.row_number().over(w)).where(F.col("at") <= k)          # k groups hold k units
    before = F.sum("units").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("units")
    return ranked.withColumn("before", before).where(F.col("before") < k) \
        .withColumn("take", F.least("units", F.lit(k) - F.col("before"))).drop("at", "before")


def _meet(visits: DataFrame, groups: DataFrame, width: int, k: int, first_class, exclude_self: bool, schema: str) -> DataFrame:
    """Visits against the pieces of their cells, in blocks of queries: one row
    per visit and piece with its nearest groups and the distances computed."""
    per = visits.groupBy("cell", "piece").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(QUERY_BLOCK))).cast("int").alias("blocks"))
    q = visits.join(per, ["cell", "piece"]).withColumn("block", F.pmod(F.xxhash64("qid"), F.col("blocks")).cast("int"))
    g = groups.join(per, ["cell", "piece"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    key = ["cell", "piece", "block"]
    both = q.select(*key, F.lit(True).alias("is_q"), F.col("qid").alias("id"), "v", F.col("q_label").alias("lab"),
                    F.lit(0).cast("long").alias("w"), "away", "worst") \
        .unionByName(g.select(*key, F.lit(False).alias("is_q"), F.col("gid").alias("id"), "v", F.col("n_label").alias("lab"),
                              "w", "away", F.lit(None).cast("double").alias("worst")))

    def solve(part: pa.Table) -> pa.Table:
        is_q = part.column("is_q").combine_chunks()
        qs, gs = part.filter(is_q), part.filter(pa.compute.invert(is_q))
        qv, gv = (_matrix(x.column("v"), width) for x in (qs, gs))
        q_away, g_away = (x.column("away").to_numpy() for x in (qs, gs))
        worst = qs.column("worst").to_numpy().astype(np.float64)                              # null: nan
        weight, ids = gs.column("w").to_numpy(), gs.column("id").to_pylist()
        g_lab, q_lab = gs.column("lab").to_pylist(), qs.column("lab").to_pylist()
        first = np.array([first_class is not None and x == first_class for x in g_lab], bool)
        by_id = np.argsort(np.argsort(gs.column("id").to_numpy(zero_copy_only=False), kind="stable"), kind="stable")
        met, hits = [], []
        for i in range(len(qs)):
            live = np.flatnonzero(~((np.abs(g_away - q_away[i]) * (1 - 1e-9)) ** 2 > worst[i]))
            met.append(len(live))
            diff = gv[live] - qv[i]
            d2 = np.einsum("ij,ij->i", diff, diff)
            units = weight[live].copy()
            if exclude_self:
                for j in np.flatnonzero(~diff.any(axis=1)):
                    units[j] -= g_lab[live[j]] == q_lab[i]
            ok = (units > 0) & ~(d2 > worst[i])
            live, d2, units = live[ok], d2[ok], units[ok]
            order = np.lexsort((by_id[live], ~first[live], d2))[:k]
            hits.append([{"gid": ids[live[j]], "n_label": g_lab[live[j]], "n_vec": gv[live[j]], "units": int(units[j]), "d2": float(d2[j])}
                         for j in order])
        kind = pa.list_(pa.struct([("gid", gs.schema.field("id").type), ("n_label", gs.schema.field("lab").type),
                                   ("n_vec", pa.list_(pa.float64())), ("units", pa.int64()), ("d2", pa.float64())]))
        return pa.table({"qid": qs.column("id"), "met": pa.array(met, pa.int64()), "hits": pa.array(hits, kind)})

    return both.groupBy(*key).applyInArrow(solve, schema)
