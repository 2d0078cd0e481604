"""Evaluation tables (E1-E9) as aggregations.

All metrics of a classifier come from one confusion aggregate (k x k rows);
AUC is exact by rank sums over the distinct-score table, whose running
counts use ``ordered_scan`` (no single-partition sort). Library evaluators
are offered next to them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import (BinaryClassificationEvaluator,
                                   MulticlassClassificationEvaluator)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.operators.ordered import ordered_scan, range_bucketed
from kiln.operators.split import first_n_per_group

LOG_LOSS_EPS = 1e-15  # fixed value: probability clip used by log loss


def confusion(scored: DataFrame, classes: Sequence, label: str = "label",
              prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n) over the full class grid, zero-filled, plus
    every other pair that occurs (unlisted classes, nulls), so all rows are
    counted; rows are the truth."""
    t = scored.schema[label].dataType
    seen = scored.select(F.col(label).alias("label"), F.col(prediction).cast(t).alias("prediction"), F.lit(1).alias("n"))
    listed = F.array(*[F.lit(c).cast(t) for c in classes])
    grid = scored.sparkSession.range(1).select(F.explode(listed).alias("label")) \
        .select("label", F.explode(listed).alias("prediction"), F.lit(0).alias("n"))
    return seen.unionByName(grid).groupBy("label", "prediction").agg(F.sum("n").cast("bigint").alias("n"))


def classification_metrics(conf: DataFrame, positive=1) -> DataFrame:
    """E2 + E3 from a confusion table: accuracy, support-weighted precision,
    recall and F1 (what ``MulticlassClassificationEvaluator("f1")`` reports),
    and, named apart, the F1 of the ``positive`` class; one row. Undefined
    precision/recall/F1 count as 0."""
    pc = f1_by_label(conf)
    return pc.groupBy().agg(
        F.max(F.when(F.col("label") == F.lit(positive), F.col("f1"))).alias("f1_positive"),
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("weighted_precision"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("weighted_recall"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1_weighted"),
        F.sum("tp").alias("correct"), F.sum("support").alias("total"))


def per_class_f1(t: DataFrame) -> DataFrame:
    """Per class: precision, recall and F1 from tp / support / predicted."""
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    out = t.withColumn("precision", prec).withColumn("recall", rec)
    return out.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                       F.lit(2.0) * F.col("precision") * F.col("recall")
                                       / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0)))


def f1_by_label(conf: DataFrame) -> DataFrame:
    """F1 of each class separately (trap 4: not the weighted F1)."""
    n, none = F.col("n"), F.lit(0).cast("bigint")
    truth = conf.select("label", F.when(F.col("label").eqNullSafe(F.col("prediction")), n).otherwise(none).alias("tp"),
                        n.alias("support"), none.alias("predicted"))
    said = conf.select(F.col("prediction").alias("label"), none.alias("tp"), none.alias("support"), n.alias("predicted"))
    return per_class_f1(truth.unionByName(said).groupBy("label").agg(
        F.sum("tp").alias("tp"), F.sum("support").alias("support"), F.sum("predicted").alias("predicted")))


def auc_exact(scored: DataFrame, score: str = "score", label: str = "label",
              bucket: Column | None = None, positive=1) -> DataFrame:
    """Exact area under the ROC curve by the rank-sum rule, ties counted
    half. Per distinct score: positives and negatives; the running count of
    negatives below each score comes from ``ordered_scan`` over ranges of the
    distinct scores (``range_bucketed``), whatever their values, or over
    ``bucket`` when given (non-decreasing in the score)."""
    per = scored.groupBy(F.col(score).alias("_s")).agg(
        F.count_if(F.col(label) == positive).alias("_pos"),
        F.count_if(F.col(label) != positive).alias("_neg"))
    if bucket is None:
        per, bucket = range_bucketed(per, [F.col("_s")]), F.col("_range")
    run = ordered_scan(per, [F.col("_s")], bucket, (), sums=["_neg"], rank_col="_r", size_col=None)
    below = F.col("cum__neg") - F.col("_neg")
    return run.agg(
        (F.sum(F.col("_pos") * (below + F.lit(0.5) * F.col("_neg")))
         / (F.sum("_pos") * F.sum("_neg"))).alias("auc"),
        F.sum("_pos").alias("n_pos"), F.sum("_neg").alias("n_neg"))


def regression_metrics(df: DataFrame, y: str = "label", yhat: str = "prediction") -> DataFrame:
    """E5 (+ E9 MSE): RMSE, MSE, MAE and R^2 = 1 - SSE / SST in one pass."""
    err = F.col(yhat) - F.col(y)
    return df.agg(
        F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(err * err).alias("mse"),
        F.avg(F.abs(err)).alias("mae"),
        (F.lit(1.0) - F.sum(err * err) / (F.var_pop(y) * F.count(y))).alias("r2"))


def log_loss(df: DataFrame, label: str, probs: str, eps: float = LOG_LOSS_EPS) -> DataFrame:
    """Mean cross-entropy ``-log p[label]`` (probability clipped to
    [eps, 1-eps]); ``label`` is a 0-based class index into ``probs``."""
    p = F.element_at(F.col(probs), F.col(label).cast("int") + 1)
    p = F.least(F.greatest(p, F.lit(eps)), F.lit(1.0 - eps))
    return df.agg(F.avg(-F.log(p)).alias("log_loss"))


def review_samples(scored: DataFrame, id_col: str, n: int = 25, label: str = "label",
                   prediction: str = "prediction") -> DataFrame:
    """E8 (F8 + W12): the first ``n`` correct and ``n`` wrong predictions by id."""
    s = scored.withColumn("is_correct", F.col(label) == F.col(prediction))
    return first_n_per_group(s, ["is_correct"], [F.col(id_col)], n)


def library_metrics(pred: DataFrame, label: str = "label") -> dict:
    """E1-E3 via the ``pyspark.ml`` evaluators (AUC is binned at 1000
    thresholds there, so approximate when scores have more distinct values)."""
    auc = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction",
                                        metricName="areaUnderROC").evaluate(pred)
    f1 = MulticlassClassificationEvaluator(labelCol=label, metricName="f1").evaluate(pred)
    acc = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy").evaluate(pred)
    return {"auc": auc, "f1": f1, "accuracy": acc}
