"""Linear learners from mergeable sums.

The rows are read once per Newton round (logistic) or once in all (least
squares): one aggregate of sums of products, computed in the map tasks before
anything is shuffled, brings a p x p matrix to the driver (p features, size
checked), where a p x p system is solved. Nothing else leaves the tasks, and
the result does not depend on how rows are partitioned up to rounding."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_FEATURES = 200      # p (p + 1) / 2 sums per aggregate


def _check(features: Sequence[str]) -> None:
    if not features or len(features) > MAX_FEATURES:
        raise ValueError(f"{len(features)} features: 1 to {MAX_FEATURES} are solved on the driver")


def _complete(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Rows without a null or non-finite value, as doubles."""
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in (label, *features)])
    for c in (label, *features):
        rows = rows.where(F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows


def _products(cols: Sequence[Column], weight: Column, prefix: str) -> list[Column]:
    return [F.sum(weight * a * b).alias(f"{prefix}_{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if j >= i]


def _square(row, n: int, prefix: str) -> np.ndarray:
    out = np.zeros((n, n))
    for i in range(n):
        for j in range(i, n):
            out[i, j] = out[j, i] = row[f"{prefix}_{i}_{j}"] or 0.0
    return out


@dataclass
class Moments:
    """Everything least squares needs of the rows: count, means, population
    standard deviations and the correlation matrix of features and label."""
    n: int
    mean: np.ndarray
    std: np.ndarray
    corr: np.ndarray        # (p + 1) x (p + 1), label last; 0 where a column is constant

    @staticmethod
    def of(df: DataFrame, label: str, features: Sequence[str]) -> Moments:
        """Two aggregates: means, then centred products (no cancellation)."""
        _check(features)
        rows = _complete(df, label, features)
        names = [*features, label]
        first = rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(names)]).first()
        n = first["n"]
        if not n:
            raise ValueError("no complete row to fit on")
        mean = np.array([first[f"m_{i}"] for i in range(len(names))])
        centred = [F.col(c) - F.lit(float(m)) for c, m in zip(names, mean)]
        cov = _square(rows.agg(*_products(centred, F.lit(1.0), "s")).first(), len(names), "s") / n
        std = np.sqrt(np.diag(cov))
        scale = np.outer(std, std)
        return Moments(n, mean, std, np.divide(cov, scale, out=np.zeros_like(cov), where=scale > 0))


@dataclass
class LinearFit:
    intercept: float
    coefficients: list[float]
    rounds: int = 0


def penalised(moments: Moments, reg: float, elastic: float, tol: float = 1e-10, max_rounds: int = 10_000) -> LinearFit:
    """Least squares with an elastic-net penalty on standardised features:
    minimises |y - X b|^2 / (2 n) + reg (elastic |b|_1 + (1 - elastic) |b|^2 / 2)
    over standardised columns, by coordinate descent with soft thresholds on
    the correlation matrix; coefficients are returned on the given scale. As
    in ``pyspark.ml`` the label is scaled to unit deviation and the penalty
    with it. Constant features get 0."""
    p = len(moments.mean) - 1
    x, y = slice(0, p), p
    gram, target = moments.corr[x, x], moments.corr[x, y]
    sd = moments.std
    if sd[y] == 0:
        return LinearFit(float(moments.mean[y]), [0.0] * p)
    strength = reg / sd[y]
    b = np.zeros(p)
    rounds = 0
    for rounds in range(1, max_rounds + 1):
        step = 0.0
        for j in range(p):
            if sd[j] == 0:
                continue
            r = target[j] - gram[j] @ b + gram[j, j] * b[j]
            new = math.copysign(max(abs(r) - strength * elastic, 0.0), r) / (gram[j, j] + strength * (1 - elastic))
            step, b[j] = max(step, abs(new - b[j])), new
        if step <= tol:
            break
    coef = np.divide(b * sd[y], sd[x], out=np.zeros(p), where=sd[x] > 0)
    return LinearFit(float(moments.mean[y] - coef @ moments.mean[x]), [float(c) for c in coef], rounds)


def penalty_path(df: DataFrame, label: str, features: Sequence[str], penalties: Sequence[tuple[float, float]],
                 **kw) -> list[LinearFit]:
    """One fit per (reg, elastic) from the same two scans of the rows."""
    moments = Moments.of(df, label, features)
    return [penalised(moments, reg, elastic, **kw) for reg, elastic in penalties]


def logistic(df: DataFrame, label: str, features: Sequence[str], rounds: int = 25, tol: float = 1e-10,
             reg: float = 0.0) -> LinearFit:
    """Logistic regression of a 0/1 label by Newton rounds from zero, one
    aggregate of gradient and Hessian a round. ``reg`` is a ridge penalty
    reg / 2 |b|^2 on the mean loss over standardised features (not the
    intercept). Stops after ``rounds`` or when no standardised coefficient
    moves by more than ``tol``. Constant features get 0. Rows are kept (memory,
    spilling to disk) between rounds."""
    _check(features)
    moments = Moments.of(df, label, features)
    p, n = len(features), moments.n
    live = [j for j in range(p) if moments.std[j] > 0]
    rows = _complete(df, label, features).select(
        F.col(label).alias("y"), *[((F.col(features[j]) - F.lit(float(moments.mean[j]))) / F.lit(float(moments.std[j]))).alias(f"x{j}")
                                   for j in live]).persist(StorageLevel.MEMORY_AND_DISK)
    cols = [F.lit(1.0), *[F.col(f"x{j}") for j in live]]
    b = np.zeros(len(cols))
    ridge = np.diag([0.0] + [reg] * len(live))
    done = 0
    try:
        for done in range(1, rounds + 1):
            z = F.lit(float(b[0]))
            for j, c in zip(live, b[1:]):
                z = z + F.col(f"x{j}") * F.lit(float(c))
            prob = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
            scored = rows.withColumn("_p", prob)
            row = scored.agg(*[F.sum((F.col("y") - F.col("_p")) * c).alias(f"g_{i}") for i, c in enumerate(cols)],
                             *_products(cols, F.col("_p") * (F.lit(1.0) - F.col("_p")), "h")).first()
            gradient = np.array([row[f"g_{i}"] or 0.0 for i in range(len(cols))]) / n - ridge @ b
            hessian = _square(row, len(cols), "h") / n + ridge
            step = np.linalg.lstsq(hessian, gradient, rcond=None)[0]
            b = b + step
            if np.abs(step).max(initial=0.0) <= tol:
                break
    finally:
        rows.unpersist()
    coef = np.zeros(p)
    coef[live] = b[1:] / moments.std[live]
    return LinearFit(float(b[0] - coef @ moments.mean[:p]), [float(c) for c in coef], done)
