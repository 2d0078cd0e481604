"""Ranks over ranges: quotas of many groups, AUC of scores of any spread."""
import random

import pytest
from pyspark.sql import functions as F

from kiln.operators import evaluate as ev
from kiln.operators import split as sp
from kiln.operators import stats as st


def test_quotas_of_many_groups_with_many_ties(spark):
    rng = random.Random(0)
    n = {k: rng.choice([1, 1, 1, 2, 3, 50]) for k in range(3000)}
    df = spark.createDataFrame(list(n.items()), "k long, n long").repartition(6)
    total, whole = 10_000, sum(n.values())
    exact = {k: c / whole * total for k, c in n.items()}
    base = {k: int(x) for k, x in exact.items()}
    more = sorted(n, key=lambda k: (base[k] - exact[k], k))[:total - sum(base.values())]
    got = {r.k: r.quota for r in sp.largest_remainder(df, "k", "n", total).collect()}
    assert got == {k: base[k] + (k in set(more)) for k in n} and sum(got.values()) == total
    assert sp.largest_remainder(df.limit(0), "k", "n", 5).count() == 0


@pytest.mark.parametrize("scale", [lambda x: x * 1e300, lambda x: 0.5 + x * 1e-12, lambda x: -(10.0 ** (x * 40)), lambda x: float(round(x * 3))])
def test_auc_of_any_scores(spark, scale):
    rng = random.Random(1)
    rows = [(scale(rng.random()), rng.randint(0, 1)) for _ in range(400)] + [(float("-inf"), 0), (float("inf"), 1)]
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    want = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    got = ev.auc_exact(spark.createDataFrame(rows, "score double, label int").repartition(5)).first()
    assert got.auc == pytest.approx(want) and (got.n_pos, got.n_neg) == (len(pos), len(neg))


def test_auc_plan_has_no_window_over_everything(spark):
    df = spark.range(100).select((F.col("id") / 7).alias("score"), (F.col("id") % 2).alias("label"))
    plan = ev.auc_exact(df)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window" in line and "_range" not in line and "_b" not in line]
    assert not windows


def test_shares_and_maps(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "x"), ("a", "x")], "k string, v string")
    assert {r.k: r.share for r in st.frequency_table(df, "k").collect()} == {"a": 0.75, None: 0.25}
    maps = {r.k: r.m for r in st.group_to_map(st.count_by(df, ["k", "v"]), "k", "v", "n").collect()}
    assert maps == {"a": {"x": 2, "y": 1}, None: {"x": 1}}
