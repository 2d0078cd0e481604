"""Feature transformers (M1-M8) and the ``FeatureSpec`` value object.

Vector assembly, indexing, one-hot and scaling use ``pyspark.ml`` stages
(fitted on the training rows only, applied to all rows alike). Word features
are long-form DataFrames: (row id, word, value), no fixed-width matrix.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.functions.arrays import once
from kiln.functions.strings import WORD_GAP
from kiln.functions.strings import words as word_array

# ---- fixed values: the 35 word-frequency features of the reference's spam
# table, in the reference's column order ------------------------------------
SPAM_WORDS = (
    "make", "address", "all", "our", "over", "remove", "internet", "order",
    "mail", "receive", "will", "people", "report", "addresses", "free",
    "business", "email", "you", "credit", "your", "font", "money", "lab",
    "labs", "telnet", "data", "technology", "parts", "direct", "meeting",
    "original", "project", "edu", "table", "conference",
)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns play which role (replaces hard-coded column lists)."""
    label: str
    numeric: Sequence[str] = field(default_factory=tuple)
    binary: Sequence[str] = field(default_factory=tuple)
    categorical: Sequence[str] = field(default_factory=tuple)

    def feature_columns(self) -> list[str]:
        return list(self.numeric) + list(self.binary) + list(self.categorical)


def feature_names(df: DataFrame, reserved: Sequence[str] = ("label", "features")) -> list[str]:
    """P10: all columns but the reserved ones (metadata only, no job)."""
    return [c for c in df.columns if c not in reserved]


def assembler(cols: Sequence[str], out: str = "features") -> VectorAssembler:
    """M1 / M2: assemble numeric, binary, vector or one-hot columns."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep")


def index_and_encode(categorical: Sequence[str], keep_invalid: bool = True,
                     order: str = "frequencyDesc") -> list:
    """M3 + M4: one multi-column StringIndexer (one pass over the data for all
    columns) and one multi-column OneHotEncoder. With ``keep_invalid`` a null
    or unseen value gets its own index, and the one-hot vector has a slot
    for it; the last slot is dropped as usual (2 levels -> size 3)."""
    idx_cols = [f"{c}_idx" for c in categorical]
    handle = "keep" if keep_invalid else "error"
    return [
        StringIndexer(inputCols=list(categorical), outputCols=idx_cols,
                      handleInvalid=handle, stringOrderType=order),
        OneHotEncoder(inputCols=idx_cols, outputCols=[f"{c}_vec" for c in categorical],
                      handleInvalid=handle),
    ]


def standard_scaler(inp: str, out: str, with_mean: bool = True,
                    with_std: bool = True) -> StandardScaler:
    """M5: standardise a vector (mean and sample std)."""
    return StandardScaler(inputCol=inp, outputCol=out, withMean=with_mean, withStd=with_std)


def feature_pipeline(spec: FeatureSpec, scale_numeric: bool = False,
                     out: str = "features") -> Pipeline:
    """M6: numeric (optionally scaled) + binary + one-hot categorical ->
    one vector. Fit it on the training rows; transform train and test."""
    stages: list = []
    parts: list[str] = []
    if spec.numeric:
        stages.append(assembler(spec.numeric, "_num_vec"))
        if scale_numeric:
            stages.append(standard_scaler("_num_vec", "_num_scaled"))
            parts.append("_num_scaled")
        else:
            parts.append("_num_vec")
    parts += list(spec.binary)
    if spec.categorical:
        stages += index_and_encode(spec.categorical)
        parts += [f"{c}_vec" for c in spec.categorical]
    stages.append(assembler(parts, out))
    return Pipeline(stages=stages)


def listed_shares(text: Column | str, vocabulary: Sequence[str], scale: float = 100.0) -> Column:
    """M8 for a short list of words: each word's share of the row's words
    (0 without words), in the list's order. A text is cut into words once and
    its words are compared with the whole list once; what is on the list is
    counted by word."""
    def counts(w: Column) -> Column:
        return F.struct(F.size(w).alias("n"), F.filter(w, lambda x: x.isin(*vocabulary)).alias("hits"))

    def shares(c: Column) -> Column:
        n, hits = c["n"], c["hits"]
        return F.transform(F.array(*map(F.lit, vocabulary)), lambda v: F.when(
            n > 0, F.lit(scale) * F.size(F.filter(hits, lambda x: x == v)) / n).otherwise(F.lit(0.0)))

    return once(once(word_array(text), counts), shares)


def word_shares(df: DataFrame, id_col: str, text_col: str = "text",
                keep: Sequence[str] = (), vocabulary: Sequence[str] | None = None,
                pattern: str = WORD_GAP, scale: float = 100.0,
                per_token: bool = False) -> DataFrame:
    """M8: per row and word, the word's share of the row's words (in percent
    by default, like word-frequency tables). Long form: one output row per
    (row, distinct word). ``vocabulary`` restricts the words kept (a fixed,
    caller-given list).

    ``per_token=True`` skips the per-(row, word) aggregation and returns one
    row per token with ``x = scale / n_words``: the rows of a (row, word) sum
    to its share, so any operator that only sums ``x`` (class sums, NB
    scores) gets the same result without that shuffle."""
    toks = df.select(id_col, *keep, word_array(text_col, pattern).alias("_w"))
    toks = toks.withColumn("_total", F.size("_w"))
    long = toks.select(id_col, *keep, "_total", F.explode("_w").alias("word"))
    if vocabulary is not None:
        long = long.where(F.col("word").isin(list(vocabulary)))
    if per_token:
        return long.select(id_col, *keep, "word", (F.lit(scale) / F.col("_total")).alias("x"))
    return (long.groupBy(id_col, *keep, "_total", "word").agg(F.count(F.lit(1)).alias("_n"))
            .select(id_col, *keep, "word",
                    (F.lit(scale) * F.col("_n") / F.col("_total")).alias("x")))
