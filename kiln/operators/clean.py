"""Row cleaning, projection helpers and set operations.

Thin on purpose: these are one Catalyst expression each, named so a user of
the reference finds them; filters stay declarative so they reach the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.functions.strings import is_present, trim_lower


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """F1 (any column) / F2 (a subset)."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def count_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> Column:
    """aggregate counting the rows ``drop_nulls`` would drop."""
    cols = list(subset) if subset else df.columns
    any_null = F.lit(False)
    for c in cols:
        any_null = any_null | F.col(c).isNull()
    return F.count_if(any_null).alias("dropped")


def where_equal(df: DataFrame, col: str, value) -> DataFrame:
    """F3."""
    return df.where(F.col(col) == F.lit(value))


def where_in_normalised(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """IN-list after trim + lower."""
    return df.where(trim_lower(col).isin(list(values)))


def where_present(df: DataFrame, col: str) -> DataFrame:
    """not null and non-empty."""
    return df.where(is_present(col))


def where_positive(df: DataFrame, col: str) -> DataFrame:
    """denominator guard."""
    return df.where(F.col(col) > 0)


def where_bucket(df: DataFrame, idx_col: str, n: int, i: int) -> DataFrame:
    """``idx % n == i`` (interleaved micro-batch i of n)."""
    return df.where(F.pmod(F.col(idx_col), F.lit(n)) == F.lit(i))


def split_by_correct(df: DataFrame, label: str = "label",
                     prediction: str = "prediction") -> tuple[DataFrame, DataFrame]:
    """F8: correct and incorrect predictions."""
    ok = F.col(label) == F.col(prediction)
    return df.where(ok), df.where(~ok)


def binarise(df: DataFrame, col: str, positive: str, out: str,
             numeric_threshold: float = 0.5) -> DataFrame:
    """``trim(lower(x)) == positive`` -> 1/0; if no row holds a text value
    of the two-level domain, fall back to ``x > threshold`` on the numeric
    reading. The choice needs one boolean aggregate over the column."""
    norm = trim_lower(col)
    any_text = df.agg(F.bool_or(norm == F.lit(positive))).first()[0]
    if any_text:
        return df.withColumn(out, (norm == F.lit(positive)).cast("int"))
    return df.withColumn(out, (F.col(col).try_cast("double") > numeric_threshold).cast("int"))


def union_sources(parts: Mapping[str, DataFrame], tag: str = "source") -> DataFrame:
    """Union by name of pieces, each tagged with its name."""
    out = None
    for name, df in parts.items():
        t = df.withColumn(tag, F.lit(name))
        out = t if out is None else out.unionByName(t)
    return out
