"""Toxicity: held-out accuracy, unseen misspellings, edge cases."""
import random

import numpy as np
import pytest

from kiln.llm import toxicity

BAD = ["grumblefink", "snarkvessel", "blightworm", "mudgoblin"]


_WORDS = random.Random(77)
GOOD = ["".join(_WORDS.choice("abdelmnorstu") for _ in range(_WORDS.randrange(3, 9))) for _ in range(400)]


def corpus(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        w = [rng.choice(GOOD) for _ in range(rng.randrange(20, 120))]
        toxic = int(i % 3 == 0)
        for _ in range(toxic * max(2, len(w) // 20)):
            w[rng.randrange(len(w))] = rng.choice(BAD)
        out.append((i, " ".join(w), toxic))
    return out


@pytest.fixture(scope="module")
def model():
    rows = corpus(240, 1)
    return toxicity.fit([t for _, t, _ in rows], [y for _, _, y in rows])


def test_held_out_and_misspelt(model):
    import pyarrow as pa
    rows = corpus(150, 2)
    p = toxicity._logits(pa.array([t for _, t, _ in rows]), *model)
    right = [(z > 0) == bool(y) for z, (_, _, y) in zip(p, rows)]
    assert sum(right) / len(right) >= 0.95
    swap = {"grumblefink": "grumblefiink", "snarkvessel": "xnarkvessel", "blightworm": "blightwurm", "mudgoblin": "mudgobblin"}
    full = rows
    rows = [" ".join(swap.get(w, w) for w in t.split()) for _, t, y in rows if y]
    z = toxicity._logits(pa.array(rows), *model)
    assert (z > 0).mean() >= 0.65 and (z > 0).mean() > 3 * np.mean([a > 0 for a, (_, _, y) in zip(p, full) if not y])


def test_query_rows(spark, docs):
    rows = corpus(300, 4)
    df = spark.createDataFrame([(i, t, 1.0) for i, t, _ in rows] + [(900, None, 1.0), (901, "", 1.0), (902, None, None)],
                               "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows] + [(900, 1, 0), (None, 1, 0), (5, None, 0), (0, 1, 1)],
                                   "doc_id long, toxic int, text int")
    got = {r.doc_id: r for r in toxicity.toxicity(df.repartition(5), labels).collect()}
    again = {r.doc_id: r for r in toxicity.toxicity(df.repartition(2), labels.repartition(3)).collect()}
    assert len(got) == len(rows) + 3
    assert all(got[i].score == pytest.approx(again[i].score, abs=1e-9) for i in got)
    held = [(got[i].predicted, y) for i, _, y in rows if got[i].held_out]
    assert len(held) > 50 and sum(a == b for a, b in held) / len(held) >= 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    assert got[900].score == got[901].score
    assert toxicity.toxicity(docs, labels).count() == docs.count()


def test_nothing_to_learn_from(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.toxicity(docs, none).collect()} == {0}
    assert toxicity.toxicity(docs.limit(0), none).count() == 0
