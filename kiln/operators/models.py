"""``pyspark.ml`` learners as pipeline builders.

Each builder returns an unfitted ``Pipeline`` (feature stages + learner);
``fit_evaluate`` fits on the training rows only and scores the test rows,
so no statistic of the test rows leaks into the fitted stages.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier, NaiveBayes,
                                       RandomForestClassifier)
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame

from kiln.operators.features import FeatureSpec, feature_pipeline


def _with_features(spec: FeatureSpec, learner, scale: bool = False) -> Pipeline:
    return Pipeline(stages=[feature_pipeline(spec, scale_numeric=scale), learner])


def naive_bayes(label: str = "label", features: str = "features",
                smoothing: float = 0.1) -> NaiveBayes:
    """L4: multinomial NB. The prior is smoothed too:
    ``log((N_c + l) / (N + l K))`` -- unlike the aggregation form (L1)."""
    return NaiveBayes(labelCol=label, featuresCol=features, smoothing=smoothing,
                      modelType="multinomial")


def logistic(spec: FeatureSpec, max_iter: int = 500, reg: float = 0.0,
             elastic: float = 0.0) -> Pipeline:
    """L5 (+ L11 penalties: ``elastic`` 0 = L2, 1 = L1, between = both)."""
    return _with_features(spec, LogisticRegression(labelCol=spec.label, maxIter=max_iter,
                                                   regParam=reg, elasticNetParam=elastic),
                          scale=True)


def mlp(spec: FeatureSpec, n_features: int, hidden: int = 8, n_classes: int = 2,
        max_iter: int = 500, seed: int = 0) -> Pipeline:
    """Multilayer perceptron ``[n_features, hidden, n_classes]`` (l-bfgs)."""
    return _with_features(spec, MultilayerPerceptronClassifier(
        labelCol=spec.label, layers=[n_features, hidden, n_classes], maxIter=max_iter,
        seed=seed), scale=True)


def tree(spec: FeatureSpec, seed: int = 0) -> Pipeline:
    """Decision tree with default parameters."""
    return _with_features(spec, DecisionTreeClassifier(labelCol=spec.label, seed=seed))


def forest(spec: FeatureSpec, n_trees: int = 10, seed: int = 0) -> Pipeline:
    """Random forest of 10 trees."""
    return _with_features(spec, RandomForestClassifier(labelCol=spec.label, numTrees=n_trees,
                                                       seed=seed))


def gbt(spec: FeatureSpec, max_iter: int = 10, seed: int = 0) -> Pipeline:
    """Gradient-boosted trees, 10 iterations."""
    return _with_features(spec, GBTClassifier(labelCol=spec.label, maxIter=max_iter, seed=seed))


def lasso(spec: FeatureSpec, reg: float = 0.1, elastic: float = 1.0,
          max_iter: int = 100) -> Pipeline:
    """Linear regression with an elastic-net penalty (Lasso by
    default); standardised features."""
    return _with_features(spec, LinearRegression(labelCol=spec.label, regParam=reg,
                                                 elasticNetParam=elastic, maxIter=max_iter),
                          scale=True)


ROWS_PER_PARTITION = 200_000  # rows per partition handed to an iterative learner


def right_sized(df: DataFrame, rows: int, rows_per_partition: int = ROWS_PER_PARTITION) -> DataFrame:
    """Partitions sized to the data for an iterative learner: each optimizer
    iteration is a job over every partition, so a few thousand rows belong in
    one task, while at scale the count grows with the data (capped by the
    cluster's default parallelism only from below, never from above)."""
    parallel = df.sparkSession.sparkContext.defaultParallelism
    target = max(1, -(-rows // rows_per_partition))
    if target < parallel and rows >= parallel * rows_per_partition:
        target = parallel
    return df.repartition(target)


def fit_evaluate(pipeline: Pipeline, train: DataFrame, test: DataFrame):
    """Fit on ``train`` only, return (model, scored ``test``).

    The feature stages are fitted first; their output for the training rows
    is persisted (memory, spilling to disk) with right-sized partitions before
    the learner's iterations start, so no iteration recomputes the features."""
    from pyspark import StorageLevel
    from pyspark.ml import PipelineModel
    stages = pipeline.getStages()
    feats = Pipeline(stages=stages[:-1]).fit(train)
    learner = stages[-1]
    cols = [learner.getLabelCol(), learner.getFeaturesCol()]
    built = feats.transform(train).select(*cols).persist(StorageLevel.MEMORY_AND_DISK)
    tr = right_sized(built, built.count()).persist(StorageLevel.MEMORY_AND_DISK)     # features are built once
    try:
        fitted = learner.fit(tr)
    finally:
        tr.unpersist()
        built.unpersist()
    model = PipelineModel(stages=[feats, fitted])
    return model, model.transform(test)
