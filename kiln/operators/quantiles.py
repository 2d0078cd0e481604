"""Mergeable quantile tables: exact counts of value cells, refined by passes.

A cell is a prefix of a double's order-preserving bits; per (class, column,
cell) a pass counts rows and keeps the smallest and the largest value. Counts
add up in any order, so the result does not depend on the partitioning. The
first pass looks at 12 bits (sign and exponent); each next pass opens only the
cells that matter by 4 bits more:

* ``quantile_cells``: cells holding over ``1 / cells`` of their column's rows;
* ``exact_quantiles``: the cells that contain an asked rank.

A cell of a single value is never opened, however many rows it holds. No value
is ranked, sorted across tasks or sent to the driver: shuffles carry counts of
cells. Nulls, NaN and infinities take no part."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.session import materialize

FIRST_BITS, STEP_BITS = 12, 4
PENDING = 1 << 20                  # cells a task holds before it merges them
MAX_CELLS = 8_000_000              # of all classes and columns, on the driver
CELL = "g long, prefix long, n long, lo double, hi double"


def ordered_bits(x: np.ndarray) -> np.ndarray:
    """Unsigned keys in the order of the (finite) doubles; -0.0 equals 0.0."""
    bits = (x + 0.0).view(np.uint64)
    top = np.uint64(1) << np.uint64(63)
    return np.where(bits & top, ~bits, bits | top)


def matrix(column: pa.Array, p: int) -> np.ndarray:
    """An array column of ``p`` doubles a row as a matrix; null is NaN."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, p)


def _merged(g: np.ndarray, prefix: np.ndarray, n: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> list[np.ndarray]:
    """One cell for each (g, prefix), in that order."""
    order = np.lexsort((prefix, g))
    g, prefix = g[order], prefix[order]
    first = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (prefix[1:] != prefix[:-1])])
    return [g[first], prefix[first], np.add.reduceat(n[order], first),
            np.minimum.reduceat(lo[order], first), np.maximum.reduceat(hi[order], first)]


class _Open:
    """The cells to look into: (g, prefix) pairs, found by two binary searches."""

    def __init__(self, g: np.ndarray, prefix: np.ndarray) -> None:
        self.prefixes = np.unique(prefix)
        self.pairs = np.unique(g * len(self.prefixes) + np.searchsorted(self.prefixes, prefix))

    def has(self, g: np.ndarray, prefix: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.prefixes, prefix), len(self.prefixes) - 1)
        pair = g * len(self.prefixes) + at
        found = self.pairs[np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)]
        return (self.prefixes[at] == prefix) & (found == pair)


def _count_cells(p: int, bits: int, opened: _Open | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list[np.ndarray]] = []
        held = 0
        for batch in batches:
            x = matrix(batch.column("x"), p)
            g = (batch.column("code").to_numpy().astype(np.int64)[:, None] * p + np.arange(p)).ravel()
            x = x.ravel()
            there = np.isfinite(x)
            g, x = g[there], x[there] + 0.0
            key = ordered_bits(x)
            if opened is not None:
                inside = opened.has(g, key >> np.uint64(64 - bits + STEP_BITS))
                g, x, key = g[inside], x[inside], key[inside]
            if not len(g):
                continue
            parts.append(_merged(g, key >> np.uint64(64 - bits), np.ones(len(g), np.int64), x, x))
            held += len(parts[-1][0])
            if held > PENDING:
                parts = [_merged(*map(np.concatenate, zip(*parts)))]
                held = len(parts[0][0])
                if held > PENDING // 2:
                    yield _batch(parts.pop())
                    held = 0
        if parts:
            yield _batch(_merged(*map(np.concatenate, zip(*parts))))
    return run


def _batch(cells: list[np.ndarray]) -> pa.RecordBatch:
    g, prefix, n, lo, hi = cells
    return pa.RecordBatch.from_arrays([pa.array(a) for a in (g, prefix.view(np.int64), n, lo, hi)],
                                      names=["g", "prefix", "n", "lo", "hi"])


@dataclass
class Coded:
    """Rows as (code of the class, vector x of the columns), written once."""
    rows: DataFrame
    classes: list
    p: int


def coded(df: DataFrame, label: str, cols: Sequence[str | Column]) -> Coded:
    """A null class is a class of its own. The classes (k values) are collected."""
    classes = [r[0] for r in df.select(label).distinct().orderBy(label).collect()]
    code = F.coalesce(*[F.when(F.col(label).eqNullSafe(F.lit(c)), F.lit(i)) for i, c in enumerate(classes)]) \
        if classes else F.lit(0)
    vector = F.array(*[(F.col(c) if isinstance(c, str) else c).cast("double") for c in cols])
    return Coded(materialize(df.select(code.cast("int").alias("code"), vector.alias("x")), "coded-rows"), classes, len(cols))


def _refine(c: Coded, wanted: Callable[[list[np.ndarray]], np.ndarray]) -> list[np.ndarray]:
    """Cells (g, prefix of 64 bits, n, lo, hi) in value order, opened until
    ``wanted(all cells)`` marks none that still holds different values."""
    done: list[np.ndarray] | None = None
    opened, bits = None, FIRST_BITS
    while True:
        found = c.rows.mapInArrow(_count_cells(c.p, bits, opened), CELL).groupBy("g", "prefix") \
            .agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).toArrow()
        new = [found.column(i).to_numpy() for i in range(5)]
        new[1] = new[1].view(np.uint64) << np.uint64(64 - bits)
        cells = new if done is None else [np.concatenate(x) for x in zip(done, new)]
        order = np.lexsort((cells[3], cells[0]))
        cells = [x[order] for x in cells]
        if len(cells[0]) > MAX_CELLS:
            raise ValueError(f"more than {MAX_CELLS} cells for {len(c.classes)} classes of {c.p} columns")
        to_open = wanted(cells) & (cells[3] < cells[4])
        if not to_open.any():
            return cells
        done = [x[~to_open] for x in cells]
        opened = _Open(cells[0][to_open], cells[1][to_open] >> np.uint64(64 - bits))
        bits += STEP_BITS


def _before(g: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the same g before each cell, and rows of its g."""
    if not len(g):
        return n, n
    first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    sizes = np.diff(np.r_[first, len(g)])
    total = np.add.reduceat(n, first)
    cum = np.cumsum(n) - n
    return cum - np.repeat(cum[first], sizes), np.repeat(total, sizes)


@dataclass
class QuantileTable:
    """Per g = code * p + column the cells in value order. Values and ranks
    meet inside a cell on the line from (its first rank, lo) to (its last
    rank, hi): a rank is off by less than the rows of one cell, which are at
    most ``1 / cells`` of the column's rows unless all are equal. A cell of
    one value has its middle rank."""
    start: dict[int, tuple[int, int]]
    n: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    before: np.ndarray
    total: np.ndarray

    def ranks(self, g: int, x: np.ndarray) -> np.ndarray:
        """Rank (from 1) over rows + 1 of each value of column ``g``; NaN for values that take no part."""
        out = np.full(len(x), np.nan)
        there = np.isfinite(x)
        if g not in self.start or not there.any():
            return out
        a, b = self.start[g]
        at = a + np.clip(np.searchsorted(self.lo[a:b], x[there], side="right") - 1, 0, b - a - 1)
        width = self.hi[at] - self.lo[at]
        one = width == 0
        part = np.where(one, 0.5, np.clip((x[there] - self.lo[at]) / np.where(one, 1.0, width), 0.0, 1.0))
        out[there] = (self.before[at] + 1 + part * (self.n[at] - 1)) / (self.total[at] + 1.0)
        return out

    def values(self, g: int, u: np.ndarray) -> np.ndarray:
        """The value at ceil(u * rows) of column ``g`` (NaN: it has none)."""
        if g not in self.start:
            return np.full(len(u), np.nan)
        a, b = self.start[g]
        rank = np.clip(np.ceil(u * self.total[a]), 1, self.total[a])
        at = a + np.searchsorted(self.before[a:b], rank, side="left") - 1
        part = (rank - self.before[at] - 1) / np.maximum(self.n[at] - 1, 1)
        return self.lo[at] + part * (self.hi[at] - self.lo[at])


def quantile_cells(c: Coded, cells: int = 256) -> QuantileTable:
    """Cells of at most ``1 / cells`` of their column's rows each (or of one
    value). The driver holds them; their number depends on classes, columns
    and ``cells``, not on the rows."""
    def heavy(x: list[np.ndarray]) -> np.ndarray:
        return x[2] * cells > np.maximum(_before(x[0], x[2])[1], cells)
    g, _, n, lo, hi = _refine(c, heavy)
    before, total = _before(g, n)
    ids, first = np.unique(g, return_index=True)
    ends = np.r_[first[1:], len(g)]
    return QuantileTable({int(i): (int(a), int(b)) for i, a, b in zip(ids, first, ends)}, n, lo, hi, before, total)


def exact_quantiles(df: DataFrame, label: str, cols: Sequence[str | Column], probs: Sequence[float]) -> DataFrame:
    """(label, j, prob, n, value): of column j in each class the value at rank
    max(1, ceil(prob * n)) of its n finite values, exactly. A column without
    finite values in a class has no rows; an empty table gives none."""
    c = coded(df, label, cols)
    probs = sorted(set(probs))

    def ranks(total: np.ndarray) -> np.ndarray:
        return np.maximum(1, np.ceil(total[:, None] * np.asarray(probs, float)))

    def asked(x: list[np.ndarray]) -> np.ndarray:
        before, total = _before(x[0], x[2])
        r = ranks(total)
        return ((r > before[:, None]) & (r <= (before + x[2])[:, None])).any(axis=1)

    g, _, n, lo, _ = _refine(c, asked)
    before, total = _before(g, n)
    at, which = np.nonzero((ranks(total) > before[:, None]) & (ranks(total) <= (before + n)[:, None]))
    rows = [(c.classes[int(g[a]) // c.p], int(g[a]) % c.p, float(probs[w]), int(total[a]), float(lo[a])) for a, w in zip(at, which)]
    field = df.schema[label].dataType.simpleString()
    return df.sparkSession.createDataFrame(rows, f"`{label}` {field}, j int, prob double, n long, value double")
