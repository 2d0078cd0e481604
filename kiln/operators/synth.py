"""Synthetic rows: class-wise Gaussian copula (G6) with class quotas.

The marginals are mergeable quantile tables (``quantiles.quantile_cells``):
value cells with exact counts per class and column, none holding over 1 / 256
of the rows unless they are equal. A value's rank is read off the table
(a rank is off by less than one cell's rows) -> normal scores
``Phi^-1(r/(n+1))`` -> the p x p correlation of the scores per class (sums of
products, added up per Arrow batch and then per class; k small matrices go to
the driver), corrected for tied values -> Cholesky factor per class. Synthetic rows are drawn on the
executors: ``spark.range(N)``, a class by cumulative quota, p seeded normal
draws mixed by the class's factor, mapped to ``u = Phi(z)`` and back to values
by the same table. Only counts of cells and sums of products are shuffled.

With empirical marginals, the per-class z-scoring before the fit and its
inverse after sampling cancel out, so they are not applied separately.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.operators.quantiles import QuantileTable, coded, matrix, quantile_cells
from kiln.operators.split import largest_remainder
from kiln.operators.stats import count_by

# ---- fixed values: coefficients of published approximations ---------------
# Inverse normal CDF, rational approximation by P. J. Acklam (no refinement step;
# abs. error about 1e-5 in the tails, 1e-9 in the centre).
_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
      1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
      6.680131188771972e+01, -1.328068155288572e+01)
_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
      -2.549671010229528e+00, 4.374664141464968e+00, 2.938163982698783e+00)
_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
      3.754408661907416e+00)
_P_LOW = 0.02425
# Error function, Abramowitz & Stegun 7.1.26 (abs. error < 1.5e-7).
_ERF_P = 0.3275911
_ERF_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
# ---------------------------------------------------------------------------


def _horner(coefs: Sequence[float], x: Column) -> Column:
    out = F.lit(coefs[0])
    for c in coefs[1:]:
        out = out * x + F.lit(c)
    return out


def norm_ppf(p: Column) -> Column:
    """Inverse standard normal CDF of ``p`` in (0, 1), as a column expression."""
    q_lo = F.sqrt(F.lit(-2.0) * F.log(p))
    lo = _horner(_C, q_lo) / (_horner(_D, q_lo) * q_lo + F.lit(1.0))
    q = p - F.lit(0.5)
    r = q * q
    mid = _horner(_A, r) * q / (_horner(_B, r) * r + F.lit(1.0))
    q_hi = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - p))
    hi = -(_horner(_C, q_hi) / (_horner(_D, q_hi) * q_hi + F.lit(1.0)))
    return F.when(p < _P_LOW, lo).when(p > 1 - _P_LOW, hi).otherwise(mid)


def normal_scores(p: np.ndarray) -> np.ndarray:
    """``norm_ppf`` of an array; NaN stays NaN."""
    tail = np.sqrt(-2.0 * np.log(np.minimum(p, 1.0 - p)))
    ends = np.polyval(_C, tail) / (np.polyval(_D, tail) * tail + 1.0)
    r = (p - 0.5) ** 2
    mid = np.polyval(_A, r) * (p - 0.5) / (np.polyval(_B, r) * r + 1.0)
    return np.where(p < _P_LOW, ends, np.where(p > 1.0 - _P_LOW, -ends, mid))


def normal_cdf(z: np.ndarray) -> np.ndarray:
    """Standard normal CDF."""
    x = np.abs(z) / math.sqrt(2.0)
    t = 1.0 / (1.0 + _ERF_P * x)
    erf = 1.0 - np.polyval(_ERF_A[::-1], t) * t * np.exp(-x * x)
    return np.where(z >= 0, 0.5 * (1.0 + erf), 0.5 * (1.0 - erf))


def _scores(x: np.ndarray, code: int, table: QuantileTable) -> np.ndarray:
    p = x.shape[1]
    return normal_scores(np.stack([table.ranks(code * p + j, x[:, j]) for j in range(p)], axis=1))


def _tie_factor(table: QuantileTable, g: int) -> float:
    """Correlation of a column's scores with the normal variable behind them:
    1 without ties, less when many rows share a value (0.80 for a coin). The
    latent correlation of two columns is their scores' over both factors."""
    if g not in table.start:
        return 1.0
    cells = slice(*table.start[g])
    share = table.n[cells] / table.total[cells]
    edges = np.r_[0.0, np.cumsum(share)[:-1], 1.0]
    inner = normal_scores(edges[1:-1])
    density = np.r_[0.0, np.exp(-inner * inner / 2.0) / math.sqrt(2.0 * math.pi), 0.0]
    moment = density * np.r_[0.0, inner, 0.0]
    mean = (density[:-1] - density[1:]) / share
    square = 1.0 + (moment[:-1] - moment[1:]) / share
    tied = (table.lo[cells] == table.hi[cells]) & (table.n[cells] > 1)
    score = np.where(tied, normal_scores((table.before[cells] + (table.n[cells] + 1) / 2.0) / (table.total[cells] + 1.0)), mean)
    along = np.where(tied, score * mean, square)
    spread = (share * np.where(tied, score * score, square)).sum() - (share * score).sum() ** 2
    return float(min(1.0, (share * along).sum() / math.sqrt(spread))) if spread > 0 else 1.0


def _pair_sums(p: int, table: QuantileTable):
    """Normal scores by the quantile table; per class code and pair (a, b) of columns, over the rows where both are
    present: rows, sum of a, sum of a squared, sum of a*b."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            rows, code = matrix(batch.column("x"), p), batch.column("code").to_numpy()
            for c in np.unique(code):
                x = _scores(rows[code == c], int(c), table)
                there = (~np.isnan(x)).astype(np.float64)
                x = np.nan_to_num(x)
                part = np.stack([there.T @ there, x.T @ there, (x * x).T @ there, x.T @ x])
                sums[c] = sums[c] + part if c in sums else part
        a, b = (pa.array(i.ravel().astype(np.int32)) for i in np.indices((p, p)))
        for c, m in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(p * p, c, np.int32)), a, b, *[pa.array(m[i].ravel()) for i in range(4)]],
                                             names=["code", "a", "b", "n", "sa", "saa", "sab"])
    return run


@dataclass
class Copula:
    """The fitted classes, each one's Cholesky factor and the marginals."""
    classes: list
    factors: list
    table: QuantileTable


def fit_copula(df: DataFrame, label: str, cols: Sequence[str], cells: int = 256) -> Copula:
    """Fit: the marginals' cells and, per class, the Cholesky factor of the
    normal-score correlation (k small matrices, collected). Nulls, NaN and
    infinities take no part; a pair of columns counts rows that have both."""
    p = len(cols)
    source = coded(df, label, cols)
    table = quantile_cells(source, cells)
    classes = source.classes
    sums = source.rows.mapInArrow(_pair_sums(p, table), "code int, a int, b int, n double, sa double, saa double, sab double") \
        .groupBy("code", "a", "b").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "saa", "sab")])
    found = {c: np.zeros((4, p, p)) for c in range(len(classes))}
    for r in sums.collect():                                               # k * p * p rows
        found[r.code][:, r.a, r.b] = r.n, r.sa, r.saa, r.sab
    factors = []
    for c, (n, sa, saa, sab) in found.items():
        with np.errstate(divide="ignore", invalid="ignore"):
            spread = saa - sa * sa / n
            m = (sab - sa * sa.T / n) / np.sqrt(spread * spread.T)
        untied = np.array([_tie_factor(table, c * p + j) for j in range(p)])
        m = np.clip(m / np.outer(untied, untied), -1.0, 1.0)
        # rounded: sums added up in another order give the same factor
        m = np.round(np.where(np.isfinite(m), m, 0.0), 9)
        np.fill_diagonal(m, 1.0)
        w, vecs = np.linalg.eigh(m)                 # keep the matrix positive definite
        m = vecs @ np.diag(np.clip(w, 1e-9, None)) @ vecs.T
        d = np.sqrt(np.diag(m))
        factors.append(np.linalg.cholesky(m / np.outer(d, d)))
    return Copula(classes, factors, table)


def _drawn(model: Copula, p: int):
    """Independent normal draws times the factor of the row's class, mapped to
    values by the class's marginals."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            e, code = matrix(batch.column("e"), p), batch.column("_ci").to_numpy()
            x = np.empty_like(e)
            for c in np.unique(code):
                # column by column: a row's sums do not depend on which rows share its batch
                mine = e[code == c]
                z = np.stack([(mine[:, :i + 1] * model.factors[c][i, :i + 1]).cumsum(axis=1)[:, -1] for i in range(p)], axis=1)
                x[code == c] = np.stack([model.table.values(int(c) * p + j, u) for j, u in enumerate(normal_cdf(z).T)], axis=1)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * p)
            values = pa.array(x.ravel(), mask=np.isnan(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("sid"), batch.column("_ci"),
                                              pa.ListArray.from_arrays(offsets, values)], names=["sid", "_ci", "x"])
    return run


def sample_copula(df: DataFrame, id_col: str, label: str, cols: Sequence[str], n_rows: int,
                  seed: int = 0, cells: int = 256, partitions: int | None = None) -> DataFrame:
    """G6 + G7: ``n_rows`` synthetic rows, classes in proportion to the source
    (largest remainder quotas), each class from its own copula. Output:
    (sid, label, *cols). A column without values in a class is null there; an
    empty source gives no rows. ``id_col`` takes no part."""
    spark = df.sparkSession
    p = len(cols)
    model = fit_copula(df, label, cols, cells)
    if not model.classes:
        return df.select(F.lit(0).cast("long").alias("sid"), label, *[F.col(c).cast("double").alias(c) for c in cols]).limit(0)
    quota = {r[label]: int(r["quota"]) for r in
             largest_remainder(count_by(df, [label]), label, "n", n_rows).select(label, "quota").collect()}   # k rows
    cum = np.cumsum([quota[c] for c in model.classes]).tolist()
    parts = partitions or spark.sparkContext.defaultParallelism
    base = spark.range(0, n_rows, 1, parts).withColumnRenamed("id", "sid")
    cidx = F.size(F.filter(F.array(*[F.lit(c) for c in cum]), lambda c: c <= F.col("sid")))
    base = base.withColumn("_ci", cidx)
    # normal draws from hash uniforms: the same rows whatever the partitioning
    draws = F.transform(F.sequence(F.lit(0), F.lit(p - 1)), lambda j: (F.conv(F.substring(F.md5(
        F.concat_ws(":", F.lit(str(seed)), j.cast("string"), F.col("sid").cast("string"))), 1, 8), 16, 10)
        .cast("double") + 0.5) / 4294967296.0)
    syn = base.select("sid", "_ci", F.transform(draws, norm_ppf).alias("e")) \
        .mapInArrow(_drawn(model, p), "sid long, _ci int, x array<double>")
    named = F.element_at(F.array(*[F.lit(c).cast(df.schema[label].dataType) for c in model.classes]), F.col("_ci") + 1)
    return syn.select("sid", named.alias(label), *[F.get("x", F.lit(j)).alias(c) for j, c in enumerate(cols)])
