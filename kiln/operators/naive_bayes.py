"""Multinomial Naive Bayes by aggregation (L1, L2) and the class-ratio
ranking of features (L3), on long-form features ``(id, label, word, x)``.

Training is two hash aggregates ((label, word) sums; per-label mass and row
counts) -- no Python on the executors. The model is two small tables:
``prior`` (one row per class) and ``theta`` (one row per class and feature).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.operators.joins import skew_safe_join
from kiln.operators.stats import expand_grid
from kiln.session import materialize


@dataclass
class NBModel:
    prior: DataFrame      # label, n, pi, theta_default
    theta: DataFrame      # label, word, theta
    classes: list         # sorted class labels (k values, collected)
    n_features: int


def spam_word_ratio(features: DataFrame, rows: DataFrame, label: str = "label",
                    positive=1, negative=0, top: int = 5) -> DataFrame:
    """L3: per feature, the positive-class mean over the negative-class mean;
    features with a zero negative mean are dropped (F6); the ``top`` largest
    ratios, ties to the later feature (features are ordered by name).

    ``features``: (id, label, word, x) long form. ``rows``: (id, label), one
    row per example, which gives the class sizes (rows with no feature count).
    """
    is_pos, is_neg = F.col(label) == positive, F.col(label) == negative
    # Class sizes: one row of two numbers, collected and applied as literals.
    # A class with no rows gives a null mean, so null ratios.
    n_pos, n_neg = rows.agg(F.count_if(is_pos), F.count_if(is_neg)).first()
    by_word = (features.groupBy("word").agg(
        F.coalesce(F.sum(F.when(is_pos, F.col("x"))), F.lit(0.0)).alias("s_pos"),
        F.coalesce(F.sum(F.when(is_neg, F.col("x"))), F.lit(0.0)).alias("s_neg"))
        .select("word", F.try_divide("s_pos", F.lit(n_pos or None).cast("bigint")).alias("pos_freq"),
                F.try_divide("s_neg", F.lit(n_neg or None).cast("bigint")).alias("neg_freq")))
    ratios = (by_word.where(F.col("neg_freq") > 0)
              .withColumn("ratio", F.col("pos_freq") / F.col("neg_freq")))
    ranked = ratios.withColumn("_rk", F.round("ratio", 9))
    out = ranked.orderBy(F.col("_rk").desc_nulls_last(), F.col("word").desc()).limit(top)
    return out.select("word", F.round("ratio", 6).alias("ratio"),
                      F.round("pos_freq", 6).alias("pos_freq"),
                      F.round("neg_freq", 6).alias("neg_freq"))


def train(features: DataFrame, rows: DataFrame, label: str = "label",
          alpha: float = 0.1, vocabulary: DataFrame | None = None,
          check_nonneg: bool = True) -> NBModel:
    """L1: ``pi_c = log(N_c / N)`` (not smoothed), ``theta_cj =
    log((S_cj + alpha) / (M_c + alpha * V))`` with ``S_cj`` the feature sum in
    class c, ``M_c`` the class's total feature mass and ``V`` the number of
    features (the vocabulary: all features seen in training unless given).

    Like ``Estimator.fit`` this is eager: the (class, feature) sums are
    computed once, and the two model tables are written to the shared
    checkpoint folder (they survive executor loss and carry no lineage).
    Features may be per (row, word) or per token: only sums of ``x`` matter.
    A negative feature value fails the job (multinomial NB needs counts);
    the check rides inside the aggregation, no extra pass."""
    x = F.col("x")
    if check_nonneg:
        x = F.when(x < 0, F.raise_error(F.lit("multinomial Naive Bayes needs non-negative features"))) \
            .otherwise(x)
    sums = features.groupBy(label, "word").agg(F.sum(x).alias("s")).persist()
    try:
        vocab = vocabulary if vocabulary is not None else sums.select("word").distinct()
        n_features = vocab.count()
        sizes = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
        mass = sums.groupBy(label).agg(F.sum("s").alias("mass"))
        denom = F.coalesce(F.col("mass"), F.lit(0.0)) + F.lit(alpha * n_features)
        prior = materialize(
            sizes.join(mass, label, "left")
            .withColumn("pi", F.log(F.col("n") / F.sum("n").over(Window.partitionBy())))
            .withColumn("theta_default", F.log(F.lit(alpha) / denom))
            .withColumn("denom", denom)
            .select(label, "n", "pi", "theta_default", "denom"), "nb-prior")
        # k classes: one row each in the prior, collected like any model parameter.
        classes = sorted(r[0] for r in prior.select(label).collect())
        grid = expand_grid(vocab.select("word"), {label: classes})
        theta = materialize(
            grid.join(sums, [label, "word"], "left")
            .join(F.broadcast(prior.select(label, "denom")), label)
            .select(label, "word",
                    F.log((F.coalesce(F.col("s"), F.lit(0.0)) + F.lit(alpha)) / F.col("denom"))
                    .alias("theta")), "nb-theta")
    finally:
        sums.unpersist()
    return NBModel(prior=prior.drop("denom"), theta=theta, classes=classes,
                   n_features=n_features)


def score(model: NBModel, features: DataFrame, rows: DataFrame, id_col: str,
          label: str = "label", max_broadcast_rows: int = 2_000_000) -> DataFrame:
    """L2: ``prediction = argmax_c pi_c + sum_j x_j theta_cj`` (ties to the
    lowest class). Features outside the model's vocabulary are ignored.
    Returns ``rows`` with a ``prediction`` column.

    The (id, word) x theta join is on ``word``, whose frequent values are hot:
    theta (V x k rows, known from training) is broadcast when that count is
    within ``max_broadcast_rows``, else the join is salted by the row id."""
    th = model.theta.withColumnRenamed(label, "_class")
    contrib = skew_safe_join(features.select(id_col, "word", "x"), th, ["word"],
                             small_rows=model.n_features * len(model.classes),
                             max_broadcast_rows=max_broadcast_rows, salt_buckets=16, salt_cols=[id_col])
    dots = contrib.groupBy(id_col, "_class").agg(F.sum(F.col("x") * F.col("theta")).alias("dot"))
    pri = model.prior.select(F.col(label).alias("_class"), "pi")
    per_class = expand_grid(rows.select(id_col), {"_class": model.classes})
    scores = (per_class.join(F.broadcast(pri), "_class")
              .join(dots, [id_col, "_class"], "left")
              .withColumn("score", F.col("pi") + F.coalesce(F.col("dot"), F.lit(0.0))))
    names = F.array(*[F.lit(c) for c in model.classes])          # ascending: the first wins a tie
    best = scores.groupBy(id_col).agg(
        F.max(F.struct(F.col("score"), (-F.array_position(names, F.col("_class"))).alias("neg"))).alias("b"))
    pred = best.select(id_col, F.element_at(names, (-F.col("b.neg")).cast("int")).alias("prediction"))
    return rows.join(pred, id_col, "left")
