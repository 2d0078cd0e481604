"""Ordinal regression: ordered grades, held-out accuracy, edge cases."""
import random

import numpy as np
import pyarrow as pa
import pytest

from kiln.llm import ordinal


def corpus(n, seed):
    """Three grades by how many words end in junk."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        g = i % 3
        w = ["".join(rng.choice("aeilnorst") for _ in range(5)) for _ in range(rng.randrange(40, 90))]
        out.append((i, " ".join(x + "$$$" if rng.random() < (0.9, 0.4, 0.0)[g] else x for x in w), g))
    return out


def test_fit_orders_grades():
    rows = corpus(300, 1)
    w, cut = ordinal.fit([t for _, t, _ in rows], [g for _, _, g in rows], 3)
    assert cut[0] < cut[1]
    test = corpus(120, 2)
    tail = ordinal._sigmoid(ordinal._latent(pa.array([t for _, t, _ in test]), w)[:, None] - cut)
    assert (tail[:, 0] >= tail[:, 1]).all()
    pred = (tail > 0.5).sum(axis=1)
    assert np.mean(pred == [g for _, _, g in test]) >= 0.9


def test_gradient_direction_for_two_grades():
    texts, y = ["good clean prose"] * 30 + ["bad!! junk!!"] * 30, [1] * 30 + [0] * 30
    w, cut = ordinal.fit(texts, y, 2)
    z = ordinal._latent(pa.array(["good clean prose", "bad!! junk!!"]), w) - cut[0]
    assert z[0] > 0 > z[1]


def test_query_rows(spark, docs):
    rows = corpus(240, 5)
    df = spark.createDataFrame([(i, t, True) for i, t, _ in rows] + [(900, None, True), (901, "", False), (None, "x", None)],
                               "doc_id long, text string, kept boolean")
    grades = spark.createDataFrame([(i, g) for i, _, g in rows] + [(None, 1), (3, None), (900, 2)], "doc_id long, grade int")
    got = {r.doc_id: r for r in ordinal.quality(df.repartition(4), grades).collect()}
    assert len(got) == len(rows) + 3 and got[900].expected_grade == got[901].expected_grade
    assert all(0 <= r.p_good <= 1 and 0 <= r.expected_grade <= 2 and r.kept == (r.p_good >= 0.5) for r in got.values())
    mean = [np.mean([got[i].expected_grade for i, _, g in rows if g == k and got[i].held_out]) for k in range(3)]
    assert mean[0] < mean[1] < mean[2]
    none = spark.createDataFrame([], "doc_id long, grade int")
    assert all(r.kept and r.expected_grade == 0 for r in ordinal.quality(docs, none).collect())
    assert ordinal.quality(docs.limit(0), grades).count() == 0


def test_grades_are_checked(spark, docs):
    with pytest.raises(ValueError):
        ordinal.train(docs, spark.createDataFrame([(1, -1)], "doc_id long, grade int"))
