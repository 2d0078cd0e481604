"""Borderline-SMOTE queries on documents + labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators import neighbors as nb
from kiln.operators.split import stratified_split
from kiln.plans.registry import query
from kiln.sources.io import read_table

MINORITY, MAJORITY = 0, 1


def _train(spark, sf_dir):
    """Training rows (stratified 70/30 by quality) with 3 features: length in
    thousands of characters, words in hundreds, is-English. Fixed scales (not
    fitted ones) keep the distances bit-identical to the SQL oracle."""
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "n_chars"]).select(
        "doc_id",                                                       # the texts stay where they are read
        F.array(F.col("n_chars").cast("double") / F.lit(1000.0),
                F.size(F.split("text", " ")).cast("double") / F.lit(100.0),
                F.when(F.col("lang") == "en", F.lit(1.0)).otherwise(F.lit(0.0))).alias("v"))
    lab = read_table(spark, sf_dir, "labels", ["doc_id", F.col("quality").alias("label")])
    # labels grow with the documents: never broadcast
    f = d.join(lab.hint("merge"), "doc_id").select("doc_id", "label", "v")
    return stratified_split(f, "doc_id", "label", 0.7, seed=0).where("split = 'train'").drop("split")


@query("smote_danger_points", sql="""
WITH f AS (SELECT d.doc_id, l.quality AS label,
                  [d.n_chars::DOUBLE / 1000.0::DOUBLE, len(string_split(d.text, ' '))::DOUBLE / 100.0::DOUBLE,
                   CASE WHEN d.lang = 'en' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END] AS v
           FROM documents d JOIN labels l USING (doc_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('0:' || doc_id::varchar), doc_id) AS rk,
             count(*) OVER (PARTITION BY label) AS n FROM f),
tr AS (SELECT doc_id, label, v FROM r WHERE rk <= floor(0.7 * n)),
pairs AS (SELECT m.doc_id AS qid, t.label,
                 list_sum(list_transform(range(1, 4), lambda i: (m.v[i] - t.v[i]) * (m.v[i] - t.v[i]))) AS d2,
                 t.doc_id AS rid
          FROM tr m JOIN tr t ON t.doc_id <> m.doc_id WHERE m.label = 0),
nn AS (SELECT qid, label FROM (
         SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d2, (label = 1) DESC, rid) AS rn FROM pairs)
       WHERE rn <= 5),
c AS (SELECT qid AS doc_id, count_if(label = 1)::BIGINT AS n_majority FROM nn GROUP BY qid)
SELECT doc_id, n_majority, n_majority >= 2.5 AND n_majority < 5 AS danger FROM c
""")
def q_smote_danger_points(spark, sf_dir):
    """J5 + G5 step 1: minority training rows with their majority count among
    the 5 nearest neighbours (exact grid kNN) and the danger flag."""
    tr = _train(spark, sf_dir)
    return nb.danger_points(tr, "doc_id", "v", "label", MINORITY, MAJORITY, m=5) \
        .select("doc_id", "n_majority", "danger")


@query("smote_balance")
def q_smote_balance(spark, sf_dir):
    """Borderline-SMOTE (k=2, m=5) on the training rows only; the result
    is the balanced training table (original + synthetic rows)."""
    tr = _train(spark, sf_dir)
    syn = nb.borderline_smote(tr, "doc_id", "v", "label", MINORITY, MAJORITY, k=2, m=5, seed=0)
    return tr.withColumn("synthetic", F.lit(False)).unionByName(syn.withColumn("synthetic", F.lit(True)))
