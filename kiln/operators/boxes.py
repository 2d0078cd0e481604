"""Exact k nearest neighbours in few dimensions.

Reference points are collapsed into (location, class) groups with a weight,
queries into one row per (location, class), so a third of all rows at one
point are one group and one query. The groups are cut into cells by median
splits of a bounded sample (the widest dimension first), so dense regions get
small cells and sparse ones large ones; a crowded cell is split into pieces.
A cell is described by the box around its groups.

Two steps on (cell, piece, block of queries) keys of bounded size give the
exact answer: a query meets the groups of its own cell, which bounds its k-th
distance, and then those of every other cell whose box is not farther than
that. Distances to boxes are summed in the order of the distances themselves,
so no rounding puts a point nearer than its box. The driver holds the sample
and one row per cell; no side of a join is broadcast."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.functions.arrays import squared_distance
from kiln.session import materialize

CELL_GROUPS = 512
MAX_CELLS = 4096              # a power of two
SAMPLE_PER_CELL = 8
QUERY_BLOCK = 1024
SLICE_VALUES = 1 << 20        # distances that a task holds at a time
SLICE_ROWS = 1 << 14          # rows that a task repeats at a time


def _matrix(col: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), width)


def _slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, max(1, rows)):
            yield batch.slice(at, max(1, rows))


def _kind(vec: str) -> Column:
    """A sign per component: ``.`` finite, ``n`` null, ``x`` NaN, ``+`` and
    ``-`` infinite. Vectors of two kinds that are not both finite throughout
    have the same distance whatever their finite components."""
    return F.array_join(F.transform(vec, lambda x: F.when(x.isNull(), "n").when(F.isnan(x), "x").when(
        x == float("inf"), "+").when(x == float("-inf"), "-").otherwise(".")), "")


class _Splits:
    """Median splits of a sample, as a complete binary tree in heap order."""

    def __init__(self, sample: np.ndarray, depth: int) -> None:
        self.depth = depth
        self.dim, self.cut = np.zeros(1 << depth, np.int64), np.full(1 << depth, np.inf)
        parts = {1: sample}
        for node in range(1, 1 << depth):
            part = parts.pop(node)
            above = np.zeros(len(part), bool)
            if len(part) > 1:
                dim = int(np.argmax(part.max(0) - part.min(0)))
                s = np.sort(part[:, dim])
                cut = s[(len(s) - 1) // 2]
                if cut == s[-1]:                               # the greatest value: both sides get some if it has others below
                    below = s[s < cut]
                    cut = below[-1] if len(below) else np.inf
                self.dim[node], self.cut[node] = dim, cut
                above = part[:, dim] > cut
            parts[2 * node], parts[2 * node + 1] = part[~above], part[above]

    def cell(self, v: np.ndarray) -> np.ndarray:
        node, rows = np.ones(len(v), np.int64), np.arange(len(v))
        for _ in range(self.depth):
            node = 2 * node + (v[rows, self.dim[node]] > self.cut[node])
        return node - (1 << self.depth)


class _Boxes:
    """What is known of the cells: boxes, units and pieces. Sent to the tasks."""

    def __init__(self, low: np.ndarray, high: np.ndarray, units: np.ndarray, pieces: np.ndarray) -> None:
        self.low, self.high, self.units, self.pieces = low, high, units, pieces

    def least(self, v: np.ndarray) -> np.ndarray:
        """Squared distance of every row to the nearest point of every box."""
        out = np.zeros((len(v), len(self.units)))
        for i in range(v.shape[1]):
            x = v[:, i, None]
            gap = np.maximum(np.maximum(self.low[:, i] - x, x - self.high[:, i]), 0)
            out += gap * gap
        return out

    def within(self, v: np.ndarray, units: int) -> np.ndarray:
        """A squared distance within which every row has so many units
        (infinite where there are fewer): from the farthest corners."""
        far = np.zeros((len(v), len(self.units)))
        for i in range(v.shape[1]):
            x = v[:, i, None]
            gap = np.maximum(np.abs(self.low[:, i] - x), np.abs(x - self.high[:, i]))
            far += gap * gap
        order = np.argsort(far, axis=1)
        enough = np.cumsum(self.units[order], axis=1) >= units
        at = enough.argmax(1)
        return np.where(enough.any(1), np.take_along_axis(far, order[np.arange(len(v)), at][:, None], 1)[:, 0], np.inf)


def knn(queries: DataFrame, refs: DataFrame, id_col: str, vec: str, label: str, k: int, first_class=None,
        exclude_self: bool = True, max_cell_groups: int = 4096) -> DataFrame:
    """For each query (id_col, vec[, label]) the ``k`` nearest reference units,
    less the query itself with ``exclude_self`` (it is then a reference row).
    Rows: (qid, n_vec, n_label, take, d2) with sum(take) = min(k, available)
    per query; a task never holds more than about ``max_cell_groups`` groups.

    Ties at equal distance go to ``first_class``, then to the other classes,
    then to no class, then to the smallest id. Rows that share a query id are
    one query with the units of all; a query without an id has none. A null
    component makes the distance null: such vectors meet those with nulls in
    the same places, in the order of ties, and each unit counts three times for
    every null. Null and empty vectors take no part."""
    spark = queries.sparkSession
    kinds, given = dict(refs.dtypes), dict(queries.dtypes)
    id_type, label_type = kinds[id_col], kinds[label]
    vec_type = "array<float>" if kinds[vec] == given[vec] == "array<float>" else "array<double>"
    hit = f"gid: {id_type}, n_label: {label_type}, n_vec: {vec_type}, rank: int, units: bigint, d2: double"
    rank = F.lit(0) if first_class is None else F.when(F.col(label).isNull(), 2).when(F.col(label) == F.lit(first_class), 0).otherwise(1)
    groups = materialize(
        refs.where(F.size(vec) > 0).groupBy(F.col(vec).cast(vec_type).alias("v"), F.col(label).alias("lab"), rank.alias("rank"))
        .agg(F.count(F.lit(1)).alias("w"), F.min(id_col).alias("gid"))
        .select("v", "lab", "rank", "w", "gid", _kind("v").alias("kind"), F.xxhash64("v", "lab").alias("slot")), "knn-groups")
    own = F.col(label).cast(label_type) if exclude_self else F.lit(None).cast(label_type)
    mine = materialize(queries.where(F.size(vec) > 0).select(
        F.col(id_col).alias("qid"), F.col(vec).cast(vec_type).alias("v"), own.alias("lab")), "knn-queries")
    asked = materialize(mine.select("v", "lab").distinct().select(
        F.monotonically_increasing_id().alias("q"), "v", "lab", _kind("v").alias("kind")), "knn-asked")

    odd = ~F.col("kind").rlike(r"^\.+$")
    sizes = [F.count(F.lit(1)).alias("n"), F.count_if(odd).alias("odd"), F.min(F.size("v")).alias("low"), F.max(F.size("v")).alias("high")]
    size, wanted = groups.agg(*sizes).first(), asked.agg(*sizes).first()
    if not size["n"] or not wanted["n"]:
        return spark.createDataFrame([], f"qid {given[id_col]}, n_vec {kinds[vec]}, n_label {label_type}, take long, d2 double")
    if len({size["low"], size["high"], wanted["low"], wanted["high"]}) > 1:
        raise ValueError("vectors of several lengths")

    found = None
    if size["odd"] < size["n"] and wanted["odd"] < wanted["n"]:
        found = _search(asked.where(~odd).drop("kind"), groups.where(~odd).drop("kind"), size["n"] - size["odd"], size["low"], k,
                        vec_type, label_type, hit, max_cell_groups)
    if size["odd"] or wanted["odd"]:
        few = _odd(asked, groups, k)
        found = few if found is None else found.unionByName(few)
    # the queries at one location share an answer; ids that repeat share one, too
    named = mine.where(F.col("qid").isNotNull()).join(
        asked.select("q", "v", "lab").hint("merge").alias("a"),
        (F.col("a.v") == mine["v"]) & F.col("a.lab").eqNullSafe(mine["lab"])).select("qid", "q")
    hits = _nearest(named.join(_nearest(found, "q", k).hint("merge"), "q"), "qid", k)
    return materialize(hits.select("qid", F.col("n_vec").cast(kinds[vec]).alias("n_vec"), "n_label", "take", "d2"), "knn-found")


def _nearest(found: DataFrame, key: str, k: int) -> DataFrame:
    """The nearest ``k`` units of each key, and how many of a group's (take)."""
    w = Window.partitionBy(key).orderBy("d2", "rank", "gid", "n_vec")
    ranked = found.withColumn("at", F.row_number().over(w)).where(F.col("at") <= k)          # k groups hold k units
    before = F.sum("units").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("units")
    return ranked.withColumn("before", before).where(F.col("before") < k).withColumn(
        "take", F.least("units", F.lit(k) - F.col("before"))).drop("at", "before")


def _odd(asked: DataFrame, groups: DataFrame, k: int) -> DataFrame:
    """Hits where a component of the query or of the group is null or not
    finite: all groups of a kind are then equally far, so its first k + 1 do."""
    w = Window.partitionBy("kind").orderBy("rank", "gid", "v")
    first = groups.withColumn("at", F.row_number().over(w)).where(F.col("at") <= k + 1).select(
        "gid", F.col("lab").alias("n_label"), F.col("v").alias("n_vec"), "rank", "w", F.col("kind").alias("g_kind"))
    nulls = lambda c: F.translate(c, "x+-", "...")
    times = F.pow(F.lit(3.0), F.length(F.regexp_replace("kind", "[^n]", ""))).cast("bigint")
    same = F.coalesce((F.col("n_vec") == F.col("v")) & (F.col("n_label") == F.col("lab")), F.lit(False))
    return asked.join(first, nulls("kind") == nulls("g_kind")) \
        .where(~F.concat("kind", "g_kind").rlike(r"^\.+$")) \
        .withColumn("units", (F.col("w") - same.cast("int")) * times).where(F.col("units") > 0) \
        .select("q", "gid", "n_label", "n_vec", "rank", "units", squared_distance("v", "n_vec").alias("d2"))


def _search(asked: DataFrame, groups: DataFrame, n: int, width: int, k: int, vec_type: str, label_type: str, hit: str,
            max_cell_groups: int) -> DataFrame:
    """Hits (q, gid, ..., units, d2) of finite queries among ``n`` finite groups."""
    context = asked.sparkSession.sparkContext
    depth = max(0, min(MAX_CELLS, -(-n // min(CELL_GROUPS, max_cell_groups))) - 1).bit_length()
    sample = np.zeros((0, width))
    if depth:
        share = min(1 << 20, -(-(SAMPLE_PER_CELL << depth << 20) // n))                     # of 2^20 digests
        rows = groups.where(F.pmod("slot", F.lit(1 << 20)) < share).select("v").collect()
        sample = np.array([r["v"] for r in rows], np.float64).reshape(len(rows), width)
    splits = context.broadcast(_Splits(sample, depth))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, SLICE_ROWS):
            cell = splits.value.cell(_matrix(batch.column("v"), width))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))], [*batch.schema.names, "cell"])

    placed = materialize(groups.mapInArrow(place, f"{_ddl(groups)}, cell int"), "knn-placed")
    low, high = np.full((1 << depth, width), np.inf), np.full((1 << depth, width), -np.inf)
    units, pieces = np.zeros(1 << depth, np.int64), np.ones(1 << depth, np.int64)
    for r in placed.groupBy("cell").agg(
            F.count(F.lit(1)).alias("n"), F.sum("w").alias("w"), F.array(*[F.min(F.col("v")[i]) for i in range(width)]).alias("low"),
            F.array(*[F.max(F.col("v")[i]) for i in range(width)]).alias("high")).collect():
        low[r["cell"]], high[r["cell"]], units[r["cell"]] = r["low"], r["high"], r["w"]
        pieces[r["cell"]] = -(-r["n"] // max_cell_groups)
    kind = np.float32 if vec_type == "array<float>" else np.float64
    boxes = context.broadcast(_Boxes(low.astype(kind), high.astype(kind), units, pieces))
    visit_type = f"q long, v {vec_type}, lab {label_type}, worst double, cell int"
    wide = SLICE_VALUES >> depth

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A query's own cell, or the nearest that holds groups."""
        for batch in _slices(batches, wide):
            v = _matrix(batch.column("v"), width)
            cell = splits.value.cell(v)
            empty = boxes.value.units[cell] == 0
            if empty.any():
                cell[empty] = boxes.value.least(v[empty]).argmin(1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("q", "v", "lab")), pa.nulls(len(v), pa.float64()), pa.array(cell.astype(np.int32))],
                ["q", "v", "lab", "worst", "cell"])

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The other cells that may hold one of a query's ``k`` units."""
        for batch in _slices(batches, wide):
            v = _matrix(batch.column("v"), width)
            worst = batch.column("worst").to_numpy(zero_copy_only=False).astype(np.float64)   # null: nan
            open_ = np.isnan(worst)
            if open_.any():
                worst[open_] = boxes.value.within(v[open_], k + 1)
            near = (boxes.value.least(v) <= worst[:, None]) & (boxes.value.units > 0)
            near[np.arange(len(v)), batch.column("cell").to_numpy()] = False
            rows, cell = np.nonzero(near)
            for at in range(0, len(rows), SLICE_ROWS):
                r = rows[at:at + SLICE_ROWS]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(pa.array(r)) for c in ("q", "v", "lab")), pa.array(worst[r]),
                     pa.array(cell[at:at + SLICE_ROWS].astype(np.int32))], ["q", "v", "lab", "worst", "cell"])

    def meet(visits: DataFrame, name: str) -> DataFrame:
        visits = materialize(visits, f"{name}-visits")
        blocks = np.zeros(1 << depth, np.int64)
        for r in visits.groupBy("cell").count().collect():
            blocks[r["cell"]] = -(-r["count"] // QUERY_BLOCK)
        return materialize(_meet(visits, placed, blocks, boxes, width, k, hit, label_type, vec_type), f"{name}-met")

    at_home = meet(asked.mapInArrow(home, visit_type), "knn-home")
    bound = at_home.groupBy("q").agg(F.first("v").alias("v"), F.first("lab").alias("lab"), F.min("worst").alias("worst"), F.first("cell").alias("cell"))
    away = meet(bound.mapInArrow(reach, visit_type), "knn-away")
    return at_home.select("q", "hits").unionByName(away.select("q", "hits")).select("q", F.explode("hits").alias("h")).select("q", "h.*")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{c} {t}" for c, t in df.dtypes)


def _meet(visits: DataFrame, placed: DataFrame, blocks: np.ndarray, boxes, width: int, k: int, hit: str, label_type: str,
          vec_type: str) -> DataFrame:
    """Visits against the pieces of their cells, in blocks of queries: one row
    per visit and piece with the nearest groups and the k-th distance."""
    dealt = visits.sparkSession.sparkContext.broadcast(blocks)

    def repeated(batch: pa.RecordBatch, times: np.ndarray, key: np.ndarray, names: tuple[str, str]) -> Iterator[pa.RecordBatch]:
        """Each row ``times`` over with a count from 0, and its ``key``."""
        ends = np.cumsum(times)
        for at in range(0, int(ends[-1]) if len(ends) else 0, SLICE_ROWS):
            i = np.arange(at, min(at + SLICE_ROWS, ends[-1]))
            row = np.searchsorted(ends, i, side="right")
            part = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array((i - (ends - times)[row]).astype(np.int32)), pa.array(key[row].astype(np.int32))],
                [*part.schema.names, *names])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, SLICE_ROWS):
            cell = batch.column("cell").to_numpy()
            mixed = (batch.column("q").to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
            yield from repeated(batch, boxes.value.pieces[cell], mixed.astype(np.int64) % dealt.value[cell], ("piece", "block"))

    def offer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, SLICE_ROWS):
            cell = batch.column("cell").to_numpy()
            yield from repeated(batch, dealt.value[cell], batch.column("slot").to_numpy() % boxes.value.pieces[cell], ("block", "piece"))

    q = visits.mapInArrow(ask, f"{_ddl(visits)}, piece int, block int")
    g = placed.select("v", "lab", "rank", "w", "gid", "slot", "cell")
    g = g.mapInArrow(offer, f"{_ddl(g)}, block int, piece int").drop("slot")
    both = q.unionByName(g, allowMissingColumns=True)

    def solve(part: pa.Table) -> pa.Table:
        is_q = pc.is_valid(part.column("q"))
        codes = part.column("lab").combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        asks = is_q.to_numpy()
        qs, gs = part.filter(is_q), part.filter(pc.invert(is_q))
        q_lab, g_lab = codes[asks], codes[~asks]
        qv, gv = _matrix(qs.column("v"), width), _matrix(gs.column("v"), width)
        by = np.lexsort((*gv.T[::-1], pc.rank(gs.column("gid"), null_placement="at_start", tiebreaker="dense").to_numpy(),
                         gs.column("rank").to_numpy()))                                        # ties go in this order
        gs, gv, g_lab, w = gs.take(pa.array(by)), gv[by], g_lab[by], gs.column("w").to_numpy()[by]
        limit = qs.column("worst").to_numpy(zero_copy_only=False).astype(np.float64)           # null: nan
        kth, counts = np.full(len(qs), np.nan), np.zeros(len(qs), np.int64)
        of, units, away = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        step = max(1, SLICE_VALUES // max(1, len(gs)))
        for at in range(0, len(qs) if len(gs) else 0, step):
            v = qv[at:at + step]
            d2 = np.zeros((len(v), len(gv)))
            for i in range(width):
                diff = v[:, i, None] - gv[:, i]
                d2 += diff * diff
            m = min(k + 1, len(gv))                                                            # one may be the query itself
            far = np.fmin(np.partition(d2, m - 1, axis=1)[:, m - 1], limit[at:at + step])
            row, col = np.nonzero(d2 <= far[:, None])
            own = (q_lab[at + row] == g_lab[col]) & (g_lab[col] >= 0) & (v[row] == gv[col]).all(1)
            left, near = w[col] - own, d2[row, col]
            order = np.lexsort((col, near, row))
            order = order[left[order] > 0]
            row, col, left, near = row[order], col[order], left[order], near[order]
            total = np.concatenate([[0], np.cumsum(left)])
            so_far = total[1:] - total[np.searchsorted(row, row)]                             # units up to this one
            kept = so_far - left < k
            full = (so_far >= k) & kept
            kth[at + row[full]] = near[full]
            counts[at:at + step] = np.bincount(row[kept], minlength=len(v))
            of.append(col[kept])
            units.append(left[kept])
            away.append(near[kept])
        taken = gs.take(pa.array(np.concatenate(of)))
        one = [taken.column(c).combine_chunks() for c in ("gid", "lab", "v", "rank")]
        hits = pa.StructArray.from_arrays([*one, pa.array(np.concatenate(units)), pa.array(np.concatenate(away))],
                                          ["gid", "n_label", "n_vec", "rank", "units", "d2"])
        ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        return pa.table({**{c: qs.column(c) for c in ("q", "v", "lab", "cell")}, "worst": pa.array(kth, pa.float64(), mask=np.isnan(kth)),
                         "hits": pa.ListArray.from_arrays(ends, hits)})

    return both.groupBy("cell", "piece", "block").applyInArrow(
        solve, f"q long, v {vec_type}, lab {label_type}, cell int, worst double, hits array<struct<{hit}>>")
