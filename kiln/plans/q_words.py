"""Word statistics and Naive Bayes queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators import naive_bayes as nb
from kiln.operators.features import SPAM_WORDS, word_shares
from kiln.operators.split import hash_split
from kiln.operators.stats import count_by, word_count, zero_filled_grid
from kiln.plans.datasets import labelled_documents
from kiln.plans.registry import query
from kiln.sources.io import read_table

LETTERS = r"[^\p{L}]+"
ALPHA = 0.1


@query("word_count", sql=r"""
SELECT word, count(*) AS n
FROM (SELECT unnest(string_split_regex(lower(text), '[^\p{L}]+')) AS word FROM documents)
WHERE word <> ''
GROUP BY word
""")
def q_word_count(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents", ["text"])
    return word_count(docs, "text", LETTERS)


_SHARES_SQL = r"""
WITH d AS (
  SELECT d.doc_id, l.toxic AS label,
         list_filter(string_split_regex(lower(d.text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w
  FROM documents d JOIN labels l USING (doc_id)),
t AS (SELECT doc_id, label, len(w) AS total, unnest(w) AS word FROM d),
shares AS (SELECT doc_id, label, word, 100.0 * count(*) / any_value(total) AS x
           FROM t GROUP BY doc_id, label, word)
"""


@query("spam_word_ratio", sql=_SHARES_SQL + """
, sizes AS (SELECT count_if(label = 1) AS n_pos, count_if(label = 0) AS n_neg FROM d),
by_word AS (
  SELECT word, coalesce(sum(CASE WHEN label = 1 THEN x END), 0.0) / nullif(n_pos, 0) AS pos_freq,
               coalesce(sum(CASE WHEN label = 0 THEN x END), 0.0) / nullif(n_neg, 0) AS neg_freq
  FROM shares, sizes GROUP BY word, n_pos, n_neg)
SELECT word, round(pos_freq / neg_freq, 6) AS ratio, round(pos_freq, 6) AS pos_freq,
       round(neg_freq, 6) AS neg_freq
FROM by_word WHERE neg_freq > 0
ORDER BY round(pos_freq / neg_freq, 9) DESC NULLS LAST, word DESC
LIMIT 5
""")
def q_spam_word_ratio(spark, sf_dir):
    """Flagship: which words mark the positive (toxic) class? scan -> tokenise
    -> word shares -> class sums -> ratio -> top 5."""
    docs = labelled_documents(spark, sf_dir, "toxic")
    shares = word_shares(docs, "doc_id", keep=["label"], per_token=True)
    return nb.spam_word_ratio(shares, docs.select("doc_id", "label"))


def _nb_inputs(spark, sf_dir):
    docs = hash_split(labelled_documents(spark, sf_dir, "toxic"), "doc_id", 0.8, seed=0)
    shares = word_shares(docs, "doc_id", keep=["label", "split"], per_token=True)
    return docs, shares


_NB_TRAIN_SQL = _SHARES_SQL + """
, split AS (SELECT doc_id, label,
    CASE WHEN ('0x' || substr(md5('0:' || doc_id::varchar), 1, 8))::ubigint < 3435973837
         THEN 'train' ELSE 'test' END AS split FROM d),
tr AS (SELECT s.* FROM shares s JOIN split p USING (doc_id) WHERE p.split = 'train'),
vocab AS (SELECT DISTINCT word FROM tr),
v AS (SELECT count(*) AS n_features FROM vocab),
sizes AS (SELECT label, count(*) AS n FROM split WHERE split = 'train' GROUP BY label),
sums AS (SELECT label, word, sum(x) AS s FROM tr GROUP BY label, word),
mass AS (SELECT label, sum(s) AS mass FROM sums GROUP BY label),
prior AS (SELECT sz.label, sz.n, ln(sz.n / sum(sz.n) OVER ()) AS pi,
                 coalesce(m.mass, 0.0) + 0.1 * v.n_features AS denom
          FROM sizes sz LEFT JOIN mass m USING (label), v)
"""


@query("nb_train_prior", sql=_NB_TRAIN_SQL + """
SELECT label, n, round(pi, 6) AS pi, round(ln(0.1 / denom), 6) AS theta_default FROM prior
""")
def q_nb_train_prior(spark, sf_dir):
    """L1 prior: log class share (not smoothed), plus the log-probability of an
    unseen feature per class."""
    docs, shares = _nb_inputs(spark, sf_dir)
    model = nb.train(shares.where("split = 'train'"), docs.where("split = 'train'"), alpha=ALPHA)
    return model.prior.select("label", "n", F.round("pi", 6).alias("pi"),
                              F.round("theta_default", 6).alias("theta_default"))


@query("nb_train_theta", sql=_NB_TRAIN_SQL + """
SELECT p.label, vocab.word, round(ln((coalesce(s.s, 0.0) + 0.1) / p.denom), 6) AS theta
FROM vocab CROSS JOIN prior p LEFT JOIN sums s ON s.label = p.label AND s.word = vocab.word
""")
def q_nb_train_theta(spark, sf_dir):
    """L1 theta over the full class x vocabulary grid, smoothed with alpha."""
    docs, shares = _nb_inputs(spark, sf_dir)
    model = nb.train(shares.where("split = 'train'"), docs.where("split = 'train'"), alpha=ALPHA)
    return model.theta.select("label", "word", F.round("theta", 6).alias("theta"))


@query("nb_score_confusion", sql=_NB_TRAIN_SQL + """
, th AS (SELECT p.label AS c, vocab.word, ln((coalesce(s.s, 0.0) + 0.1) / p.denom) AS theta
         FROM vocab CROSS JOIN prior p LEFT JOIN sums s ON s.label = p.label AND s.word = vocab.word),
te AS (SELECT doc_id, label FROM split WHERE split = 'test'),
dots AS (SELECT sh.doc_id, th.c, sum(sh.x * th.theta) AS dot
         FROM shares sh JOIN te USING (doc_id) JOIN th ON th.word = sh.word GROUP BY sh.doc_id, th.c),
sc AS (SELECT te.doc_id, te.label, p.label AS c, p.pi + coalesce(dots.dot, 0.0) AS score
       FROM te CROSS JOIN prior p LEFT JOIN dots ON dots.doc_id = te.doc_id AND dots.c = p.label),
pred AS (SELECT doc_id, label, c AS prediction FROM (
           SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, c) AS rn FROM sc)
         WHERE rn = 1),
grid AS (SELECT a.label, b.label AS prediction FROM prior a CROSS JOIN prior b),
cnt AS (SELECT label, prediction, count(*) AS n FROM pred GROUP BY label, prediction)
SELECT g.label, g.prediction, coalesce(cnt.n, 0) AS n
FROM grid g LEFT JOIN cnt USING (label, prediction)
""")
def q_nb_score_confusion(spark, sf_dir):
    """L2 + E4: score held-out documents, zero-filled confusion table (rows =
    truth). Accuracy (E3) is the diagonal share of this table."""
    docs, shares = _nb_inputs(spark, sf_dir)
    model = nb.train(shares.where("split = 'train'"), docs.where("split = 'train'"), alpha=ALPHA)
    test_rows = docs.where("split = 'test'").select("doc_id", "label")
    scored = nb.score(model, shares.where("split = 'test'"), test_rows, "doc_id")
    counts = count_by(scored, ["label", "prediction"])
    classes = model.classes
    base = scored.sparkSession.createDataFrame([(c,) for c in classes], "label int")
    return zero_filled_grid(counts, base, {"prediction": classes}, "n", 0) \
        .select("label", "prediction", F.col("n").cast("bigint").alias("n"))


_NB_ML_SQL = rf"""
WITH d AS (
  SELECT d.doc_id, l.toxic AS label, ('0x' || substr(md5('0:' || d.doc_id::varchar), 1, 8))::ubigint < 3435973837 AS train,
         list_filter(string_split_regex(lower(d.text), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS w
  FROM documents d JOIN labels l USING (doc_id)),
words AS (SELECT unnest({list(SPAM_WORDS)}) AS word),
x AS (SELECT doc_id, label, train, word, CASE WHEN len(w) = 0 THEN 0.0 ELSE
        100.0 * len(list_filter(w, lambda v: v = word)) / len(w) END AS x FROM d CROSS JOIN words),
pr AS (SELECT label, ln(count(*) + 0.1) - ln(sum(count(*)) OVER () + 0.1 * count(*) OVER ()) AS pi
       FROM d WHERE train GROUP BY label),
s AS (SELECT label, word, sum(x) AS s FROM x WHERE train GROUP BY label, word),
th AS (SELECT label, word, ln(s + 0.1) - ln(sum(s) OVER (PARTITION BY label) + 0.1 * {len(SPAM_WORDS)}) AS theta FROM s)
"""


def _nb_ml(spark, sf_dir):
    """The library multinomial NB (smoothing 0.1) on the percent shares of the
    fixed word list, fitted on train; and the scored test rows."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import array_to_vector

    from kiln.operators.features import listed_shares
    from kiln.operators.models import naive_bayes
    from kiln.session import materialize
    # every text is read once, before the join, and only its shares travel
    shares = read_table(spark, sf_dir, "documents", ["doc_id", "text"]) \
        .select("doc_id", array_to_vector(listed_shares("text", SPAM_WORDS)).alias("features"))
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "toxic"]).withColumnRenamed("toxic", "label")
    d = materialize(hash_split(shares.join(labels, "doc_id"), "doc_id", 0.8, seed=0).select(
        "doc_id", F.col("label").cast("double").alias("label"), "split", "features"), "nb-shares")
    model = Pipeline(stages=[naive_bayes(smoothing=ALPHA)]).fit(d.where("split = 'train'"))
    return model.stages[-1], model.transform(d.where("split = 'test'")).select("label", "prediction")


@query("nb_ml_model", sql=_NB_ML_SQL + """
SELECT th.label::INTEGER AS label, th.word, round(pr.pi, 6) AS pi, round(th.theta, 6) AS theta FROM th JOIN pr USING (label)
""")
def q_nb_ml_model(spark, sf_dir):
    """L4: prior and log-probabilities of the library model, against the closed
    form (its prior is smoothed too)."""
    m, _ = _nb_ml(spark, sf_dir)
    theta = m.theta.toArray()                 # classes x 35 fixed words
    rows = [(c, w, float(m.pi[c]), float(theta[c, j])) for c in range(theta.shape[0]) for j, w in enumerate(SPAM_WORDS)]
    return spark.createDataFrame(rows, "label int, word string, pi double, theta double") \
        .select("label", "word", F.round("pi", 6).alias("pi"), F.round("theta", 6).alias("theta"))


@query("nb_ml_metrics", sql=_NB_ML_SQL + """
, sc AS (SELECT x.doc_id, x.label, pr.label AS c, any_value(pr.pi) + sum(x.x * th.theta) AS score
         FROM x JOIN pr ON true JOIN th ON th.label = pr.label AND th.word = x.word WHERE NOT x.train
         GROUP BY x.doc_id, x.label, pr.label),
pd AS (SELECT doc_id, label, c AS prediction FROM (
         SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, c) AS rn FROM sc) WHERE rn = 1),
g AS (SELECT a.label, b.label AS prediction FROM pr a CROSS JOIN pr b)
SELECT g.label::DOUBLE AS label, g.prediction::DOUBLE AS prediction, count(pd.doc_id) AS n
FROM g LEFT JOIN pd USING (label, prediction) GROUP BY g.label, g.prediction
""")
def q_nb_ml_metrics(spark, sf_dir):
    """L4 + E4: confusion table of the library model on the test rows."""
    from kiln.operators import evaluate as ev
    _, scored = _nb_ml(spark, sf_dir)
    return ev.confusion(scored, [0.0, 1.0])
