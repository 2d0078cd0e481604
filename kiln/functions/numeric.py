"""Numeric scalar functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STD_FLOOR = 1e-12  # fixed value: smallest standard deviation used to divide


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def quantise(col: Column | str, q: float) -> Column:
    """``round(x / q) * q`` with round-half-to-even (``rint``), as Python's
    ``round`` and NumPy do. Spark's ``round`` is half-up and is not used."""
    return F.rint(_c(col) / F.lit(q)) * F.lit(q)


def clip_max(col: Column | str, upper: float) -> Column:
    """``min(x, upper)``."""
    return F.least(_c(col), F.lit(upper))


def floor_std(col: Column | str, floor: float = STD_FLOOR) -> Column:
    """``max(sd, 1e-12)``."""
    return F.greatest(_c(col), F.lit(floor))


def zscore(col: Column | str, mu: Column | str, sd: Column | str) -> Column:
    """X14."""
    return (_c(col) - _c(mu)) / _c(sd)


def inverse_zscore(z: Column | str, mu: Column | str, sd: Column | str) -> Column:
    """X14 inverse."""
    return _c(z) * _c(sd) + _c(mu)


def safe_log_ratio(num: Column | str, den: Column | str) -> Column:
    """Natural log of a ratio; null if either side is not positive."""
    n, d = _c(num), _c(den)
    return F.when((n > 0) & (d > 0), F.log(n / d))


def nearest_int(col: Column | str) -> Column:
    """Nearest integer, half to even (``np.rint``)."""
    return F.rint(_c(col)).cast("bigint")
