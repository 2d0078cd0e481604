"""Evaluation queries (E1-E9) over a fixed scoring rule, and the
``pyspark.ml`` learners (L4-L12, L14, L16, M3-M6) on documents + labels."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Row
from pyspark.sql import functions as F

from kiln.operators import evaluate as ev
from kiln.operators import models as md
from kiln.operators.features import FeatureSpec, index_and_encode
from kiln.operators.split import hash_split
from kiln.operators.stats import count_by, ols
from kiln.plans.registry import query
from kiln.sources.io import read_table

# ---- a fixed scoring rule (no fitting) so every metric has an exact oracle ----

_SCORED_SQL = """
WITH s AS (SELECT d.doc_id, l.quality AS label,
                  1.0 / (1.0 + exp(-(d.n_chars - 1500) / 1000.0)) AS score
           FROM documents d JOIN labels l USING (doc_id)),
p AS (SELECT *, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS prediction FROM s)
"""


def _scored(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", ["doc_id", "n_chars"])
    lab = read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
    s = d.join(lab, "doc_id").select(
        "doc_id", F.col("quality").alias("label"),
        (F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("n_chars") - 1500) / F.lit(1000.0)))).alias("score"))
    return s.withColumn("prediction", (F.col("score") > 0.5).cast("int"))


@query("auc_exact", sql=_SCORED_SQL + """
, per AS (SELECT score, count_if(label = 1) AS pos, count_if(label <> 1) AS neg FROM p GROUP BY score),
r AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
               AS below FROM per)
SELECT round(sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)), 9) AS auc,
       sum(pos)::BIGINT AS n_pos, sum(neg)::BIGINT AS n_neg FROM r
""")
def q_auc_exact(spark, sf_dir):
    """Exact AUC by rank sums (ties count half)."""
    a = ev.auc_exact(_scored(spark, sf_dir))
    return a.select(F.round("auc", 9).alias("auc"), "n_pos", "n_neg")


@query("f1_weighted", sql=_SCORED_SQL + """
, g AS (SELECT a.c AS label, b.c AS prediction FROM (VALUES (0), (1)) a(c), (VALUES (0), (1)) b(c)),
cm AS (SELECT g.label, g.prediction, count(p.doc_id) AS n FROM g LEFT JOIN p
       ON p.label = g.label AND p.prediction = g.prediction GROUP BY g.label, g.prediction),
k AS (SELECT label, sum(n) FILTER (WHERE label = prediction) AS tp, sum(n) AS support FROM cm GROUP BY label),
q AS (SELECT prediction AS label, sum(n) AS predicted FROM cm GROUP BY prediction),
f AS (SELECT k.label, tp, support, predicted,
             CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS pr,
             CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rc FROM k JOIN q USING (label)),
f2 AS (SELECT *, CASE WHEN pr + rc > 0 THEN 2.0 * pr * rc / (pr + rc) ELSE 0.0 END AS f1 FROM f)
SELECT round(sum(tp) / sum(support), 9) AS accuracy,
       round(sum(f1 * support) / sum(support), 9) AS f1_weighted,
       round(max(f1) FILTER (WHERE label = 1), 9) AS f1_class1,
       sum(tp)::BIGINT AS correct, sum(support)::BIGINT AS total FROM f2
""")
def q_f1_weighted(spark, sf_dir):
    """E2 + E3 + E4: confusion table -> accuracy, support-weighted F1 (what
    the library evaluator calls f1) and, separately named, class-1 F1."""
    conf = ev.confusion(_scored(spark, sf_dir), [0, 1])
    m = ev.classification_metrics(conf, positive=1)
    return m.select(F.round("accuracy", 9).alias("accuracy"),
                    F.round("f1_weighted", 9).alias("f1_weighted"),
                    F.round("f1_positive", 9).alias("f1_class1"),
                    F.col("correct").cast("bigint").alias("correct"),
                    F.col("total").cast("bigint").alias("total"))


@query("rmse_r2", sql="""
WITH r AS (SELECT n_chars::DOUBLE AS y, 6.0 * len(string_split(text, ' ')) AS yhat FROM documents)
SELECT round(sqrt(avg((yhat - y) * (yhat - y))), 6) AS rmse,
       round(avg((yhat - y) * (yhat - y)), 6) AS mse,
       round(1.0 - sum((yhat - y) * (yhat - y)) / (var_pop(y) * count(y)), 9) AS r2 FROM r
""")
def q_rmse_r2(spark, sf_dir):
    """E5 + E9 (MSE): a fixed rule, six characters per space-separated word,
    as a predictor of the document length."""
    d = read_table(spark, sf_dir, "documents", ["text", "n_chars"])
    r = d.select(F.col("n_chars").cast("double").alias("label"),
                 (F.lit(6.0) * F.size(F.split("text", " "))).alias("prediction"))
    m = ev.regression_metrics(r)
    return m.select(F.round("rmse", 6).alias("rmse"), F.round("mse", 6).alias("mse"),
                    F.round("r2", 9).alias("r2"))


@query("log_loss", sql=_SCORED_SQL + """
SELECT round(avg(-ln(least(greatest(CASE WHEN label = 1 THEN score ELSE 1.0 - score END, 1e-15),
                          1.0 - 1e-15))), 9) AS log_loss FROM p
""")
def q_log_loss(spark, sf_dir):
    """Cross-entropy of the rule's class probabilities."""
    s = _scored(spark, sf_dir).withColumn("probs", F.array(F.lit(1.0) - F.col("score"), F.col("score")))
    return ev.log_loss(s, "label", "probs").select(F.round("log_loss", 9).alias("log_loss"))


@query("review_samples", sql=_SCORED_SQL + """
SELECT doc_id, label = prediction AS is_correct FROM (
  SELECT *, row_number() OVER (PARTITION BY label = prediction ORDER BY doc_id) AS rn FROM p) WHERE rn <= 25
""")
def q_review_samples(spark, sf_dir):
    """The first 25 correct and the first 25 wrong predictions."""
    return ev.review_samples(_scored(spark, sf_dir), "doc_id", 25).select("doc_id", "is_correct")


@query("class_balance", sql="""
SELECT l.toxic AS label, count(*) AS n FROM documents d JOIN labels l USING (doc_id)
GROUP BY l.toxic
""")
def q_class_balance(spark, sf_dir):
    """Rows per class."""
    from kiln.plans.datasets import labelled_documents
    return count_by(labelled_documents(spark, sf_dir, "toxic").select("label"), ["label"])


# ---- feature encoding and least squares (exact oracles) -------------------------

@query("onehot_index", sql="""
WITH f AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
ix AS (SELECT lang, (row_number() OVER (ORDER BY n DESC, lang) - 1)::DOUBLE AS idx FROM f),
k AS (SELECT count(*) AS levels FROM f)
SELECT d.doc_id, ix.idx AS lang_idx,
       list_transform(range(0, k.levels + 1), lambda j: CASE WHEN j = ix.idx THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)
         AS lang_vec
FROM documents d JOIN ix USING (lang), k
""")
def q_onehot_index(spark, sf_dir):
    """M3 + M4: string index by frequency (ties alphabetical), one-hot with an
    extra slot for null / unseen values."""
    from pyspark.ml import Pipeline
    d = read_table(spark, sf_dir, "documents", ["doc_id", "lang"])
    model = Pipeline(stages=index_and_encode(["lang"])).fit(d)
    out = model.transform(d)
    return out.select("doc_id", F.col("lang_idx").alias("lang_idx"),
                      vector_to_array("lang_vec").alias("lang_vec"))


@query("ols_fit", sql="""
WITH r AS (SELECT n_chars::DOUBLE AS y, len(string_split(text, ' '))::DOUBLE AS x FROM documents)
SELECT round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept,
       round(regr_r2(y, x), 9) AS r2, regr_count(y, x)::BIGINT AS n FROM r
""")
def q_ols_fit(spark, sf_dir):
    """Exact one-variable least squares (document length on word count)."""
    d = read_table(spark, sf_dir, "documents", ["text", "n_chars"])
    r = d.select(F.col("n_chars").cast("double").alias("y"),
                 F.size(F.split("text", " ")).cast("double").alias("x"))
    o = ols(r, "y", "x")
    return o.select(F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"),
                    F.round("r2", 9).alias("r2"), F.col("n").cast("bigint").alias("n"))


# ---- pyspark.ml learners (iterative / seeded: rows-only checks) -------------------

SPEC = FeatureSpec(label="label", numeric=("log_chars", "n_words", "mean_word_len"),
                   binary=("is_en",), categorical=("lang", "source"))


def _model_frame(spark, sf_dir):
    """documents + labels: label = quality; numeric, binary and categorical
    features; an 80/20 hash split."""
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "source", "n_chars"])
    lab = read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
    w = F.size(F.split("text", r"\s+"))
    f = d.join(lab, "doc_id").select(
        "doc_id", F.col("quality").cast("double").alias("label"),
        F.log1p(F.col("n_chars").cast("double")).alias("log_chars"),
        w.cast("double").alias("n_words"),
        (F.col("n_chars") / F.greatest(w, F.lit(1))).cast("double").alias("mean_word_len"),
        (F.col("lang") == "en").cast("double").alias("is_en"), "lang", "source")
    return hash_split(f, "doc_id", 0.8, seed=0)


def _classifier_report(pipe, spark, sf_dir, name):
    f = _model_frame(spark, sf_dir)
    _, pred = md.fit_evaluate(pipe, f.where("split = 'train'"), f.where("split = 'test'"))
    pred = pred.select("doc_id", "label", "prediction", "rawPrediction").persist()
    try:
        lib = ev.library_metrics(pred)
        conf = ev.confusion(pred, [0.0, 1.0])
        m = ev.classification_metrics(conf).first()
    finally:
        pred.unpersist()
    return spark.createDataFrame([Row(model=name, auc=float(lib["auc"]), f1_weighted=float(lib["f1"]),
                                      accuracy=float(lib["accuracy"]),
                                      f1_check=float(m["f1_weighted"]), n_test=int(m["total"]))])


@query("logreg")
def q_logreg(spark, sf_dir):
    """L5 + E1-E3: logistic regression, 500 iterations."""
    return _classifier_report(md.logistic(SPEC), spark, sf_dir, "logreg")


@query("mlp")
def q_mlp(spark, sf_dir):
    """Perceptron [n_features, 8, 2], seed 0, 500 iterations."""
    f = _model_frame(spark, sf_dir)
    n_feat = len(md.logistic(SPEC).getStages()[0].fit(f.where("split = 'train'"))
                 .transform(f.limit(1)).first()["features"])
    return _classifier_report(md.mlp(SPEC, n_feat), spark, sf_dir, "mlp")


@query("tree")
def q_tree(spark, sf_dir):
    """Decision tree, defaults, seed 0."""
    return _classifier_report(md.tree(SPEC), spark, sf_dir, "tree")


@query("forest")
def q_forest(spark, sf_dir):
    """Random forest, 10 trees, seed 0."""
    return _classifier_report(md.forest(SPEC), spark, sf_dir, "forest")


@query("gbt")
def q_gbt(spark, sf_dir):
    """Gradient-boosted trees, 10 iterations, seed 0."""
    return _classifier_report(md.gbt(SPEC), spark, sf_dir, "gbt")


REG_SPEC = FeatureSpec(label="label", numeric=("n_words", "n_lines", "n_punct"), binary=("is_en",))


def _regression_frame(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "n_chars"])
    f = d.select("doc_id", F.col("n_chars").cast("double").alias("label"),
                 F.size(F.split("text", r"\s+")).cast("double").alias("n_words"),
                 F.size(F.split("text", "\n")).cast("double").alias("n_lines"),
                 (F.length("text") - F.length(F.regexp_replace("text", r"[.,;:!?]", ""))).cast("double")
                 .alias("n_punct"),
                 (F.col("lang") == "en").cast("double").alias("is_en"))
    return hash_split(f, "doc_id", 0.8, seed=0)


def _regression_report(spark, sf_dir, variants):
    f = _regression_frame(spark, sf_dir)
    tr, te = f.where("split = 'train'"), f.where("split = 'test'")
    rows = []
    for name, reg, elastic in variants:
        model, pred = md.fit_evaluate(md.lasso(REG_SPEC, reg=reg, elastic=elastic), tr, te)
        lr = model.stages[-1]
        m = ev.regression_metrics(pred).first()
        rows.append(Row(variant=name, reg=float(reg), elastic=float(elastic),
                        intercept=float(lr.intercept), coefficients=[float(c) for c in lr.coefficients],
                        rmse=float(m["rmse"]), r2=float(m["r2"])))
    return spark.createDataFrame(rows)


@query("lasso_fit")
def q_lasso_fit(spark, sf_dir):
    """L10 + E5: Lasso (regParam 0.1, elasticNet 1, 100 iterations) of the
    document length on word, line and punctuation counts and is-English."""
    return _regression_report(spark, sf_dir, [("lasso", 0.1, 1.0)])


@query("penalty_variants")
def q_penalty_variants(spark, sf_dir):
    """The same fit under L2, L1 and mixed penalties."""
    return _regression_report(spark, sf_dir, [("l2", 0.1, 0.0), ("l1", 0.1, 1.0), ("l1_l2", 0.1, 0.5)])
