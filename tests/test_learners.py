"""Learners against the library's, brute force and edge cases."""
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from kiln.operators import cells, linear, trees
from kiln.operators import kmeans as km


def _rows(n, seed=0):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = rng.gauss(3, 2), rng.gauss(-1, 0.5), rng.randint(0, 3)
        out.append((i, a, b, float(c), int(rng.random() < 1 / (1 + math.exp(-(0.7 * a - 1.3 * b - 2)))), 2.0 * a - b + 0.3 * c + rng.gauss(0, 0.4)))
    return out


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(_rows(800), "id long, a double, b double, c double, y int, t double").repartition(4).cache()


def test_logistic_equals_the_library(frame):
    from pyspark.ml.classification import LogisticRegression
    fit = linear.logistic(frame, "y", ["a", "b", "c"])
    lib = LogisticRegression(labelCol="y", maxIter=200, tol=1e-12).fit(VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(frame))
    assert np.allclose(fit.coefficients, lib.coefficients, atol=1e-6) and abs(fit.intercept - lib.intercept) < 1e-6


def test_logistic_odd_rows_constant_features_and_one_class(spark, frame):
    more = frame.select("a", "b", "c", "y").unionByName(spark.createDataFrame(
        [(None, 1.0, 1.0, 1), (1.0, float("nan"), 1.0, 0), (1.0, 1.0, float("inf"), 0), (1.0, 1.0, 1.0, None)], "a double, b double, c double, y int"))
    one = linear.logistic(frame.withColumn("k", F.lit(5.0)), "y", ["a", "k", "b", "c"])
    two = linear.logistic(more, "y", ["a", "b", "c"])
    assert one.coefficients[1] == 0.0 and np.allclose([one.coefficients[0], *one.coefficients[2:]], two.coefficients, atol=1e-9)
    ridge = linear.logistic(frame.where("y = 1"), "y", ["a"], reg=0.1, rounds=30)
    assert all(map(math.isfinite, [ridge.intercept, *ridge.coefficients]))
    with pytest.raises(ValueError):
        linear.logistic(frame.limit(0), "y", ["a"])
    with pytest.raises(ValueError):
        linear.logistic(frame, "y", [])


@pytest.mark.parametrize("reg,elastic", [(0.0, 0.0), (0.3, 0.0), (0.3, 1.0), (0.2, 0.5), (100.0, 1.0)])
def test_penalties_equal_the_library(frame, reg, elastic):
    from pyspark.ml.regression import LinearRegression
    [fit] = linear.penalty_path(frame, "t", ["a", "b", "c"], [(reg, elastic)])
    lib = LinearRegression(labelCol="t", regParam=reg, elasticNetParam=elastic, maxIter=500, tol=1e-12, solver="l-bfgs").fit(
        VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(frame))
    assert np.allclose(fit.coefficients, lib.coefficients, atol=2e-3) and abs(fit.intercept - lib.intercept) < 1e-2


def test_moments_do_not_cancel(spark):
    df = spark.createDataFrame([(1e9 + i, 2e9 + 3 * i) for i in range(100)], "x double, y double")
    [fit] = linear.penalty_path(df, "y", ["x"], [(0.0, 0.0)])
    assert abs(fit.coefficients[0] - 3.0) < 1e-9


def _brute_tree(x, y, depth, limits):
    """Node -> (feature, bin) by trying every split."""
    def gini(rows):
        n = len(rows)
        p = sum(y[r] for r in rows) / n
        return 1 - p * p - (1 - p) ** 2
    bins = [[1 + sum(v < x[r][f] for v in limits[f]) for f in range(len(limits))] for r in range(len(x))]
    out, level = {}, {1: list(range(len(x)))}
    for _ in range(depth):
        nxt = {}
        for node, rows in level.items():
            best = None
            for f in range(len(limits)):
                for b in sorted({bins[r][f] for r in rows})[:-1]:
                    left, right = [r for r in rows if bins[r][f] <= b], [r for r in rows if bins[r][f] > b]
                    gain = round(gini(rows) - (len(left) * gini(left) + len(right) * gini(right)) / len(rows), 9)
                    if gain > 0 and (best is None or (-gain, f, b) < best[0]):
                        best = ((-gain, f, b), left, right)
            if best:
                out[node] = best[0][1:]
                nxt[2 * node], nxt[2 * node + 1] = best[1], best[2]
        level = nxt
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_tree_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    x = [[rng.choice([rng.gauss(0, 1), 0.0]), float(rng.randint(0, 5))] for _ in range(150)]
    y = [int(a + 0.4 * b + rng.gauss(0, 1) > 1) for a, b in x]
    df = spark.createDataFrame([(i, *v, c) for i, (v, c) in enumerate(zip(x, y))], "id long, a double, b double, y int").repartition(3)
    tree = trees.classification_tree(df, "y", ["a", "b"], [0, 1], depth=3, n_bins=6)
    values = [sorted(v[f] for v in x) for f in range(2)]
    limits = [sorted({v[math.ceil(i * len(v) / 6) - 1] for i in range(1, 6)} - {v[-1]}) for v in values]
    assert [tree.binning.limits[f] for f in "ab"] == limits
    assert {n.node: (["a", "b"].index(n.feature), n.bin) for n in tree.nodes.values() if n.feature} == _brute_tree(x, y, 3, limits)
    got = trees.predict_tree(df, tree, ["a", "b"], [0, 1], share="s")
    leaves = {n.node: n for n in tree.nodes.values() if n.feature is None}
    assert sum(n.rows for n in leaves.values()) == 150
    right = got.where("prediction = y").count()
    assert right == sum(max(n.value) * n.rows for n in leaves.values())


def test_tree_edges(spark):
    df = spark.createDataFrame([(0, None, 1), (1, float("nan"), 1), (2, 1.0, 0), (3, 2.0, 0), (4, 3.0, None)], "id long, a double, y int")
    tree = trees.classification_tree(df, "y", ["a"], [0, 1], depth=2, n_bins=4)
    out = {r.id: r.prediction for r in trees.predict_tree(df, tree, ["a"], [0, 1]).collect()}
    assert out == {0: 1, 1: 1, 2: 0, 3: 0, 4: 0}
    empty = trees.classification_tree(df.limit(0), "y", ["a"], [0, 1])
    assert list(empty.nodes) == [1] and trees.predict_tree(df, empty, ["a"], [0, 1]).where("prediction = 0").count() == 5
    same = trees.classification_tree(df.withColumn("a", F.lit(1.0)), "y", ["a"], [0, 1])
    assert list(same.nodes) == [1]


def test_boosting_and_forest_learn(frame):
    from kiln.operators.evaluate import auc_exact
    model = trees.boosted(frame, "y", ["a", "b", "c"], rounds=8, depth=2)
    assert all(x > y for x, y in itertools.pairwise(model.loss))
    scored = trees.predict_boosted(frame, model, ["a", "b", "c"]).select(F.col("y").alias("label"), "score")
    assert auc_exact(scored).first()["auc"] > 0.8
    wood = trees.forest(frame, "id", "y", ["a", "b", "c"], [0, 1], n_trees=4, depth=3)
    shares = trees.predict_forest(frame, wood, ["a", "b", "c"])
    assert auc_exact(shares.select(F.col("y").alias("label"), F.col("share").alias("score"))).first()["auc"] > 0.75
    assert len({tuple(sorted((n.node, n.feature, n.bin) for n in t.nodes.values() if n.feature)) for t in wood.trees}) > 1


def test_poisson_draws(spark):
    got = spark.range(20_000).select(trees.poisson(0, 1, F.col("id")).alias("k")).groupBy("k").count().collect()
    share = {r["k"]: r["count"] / 20_000 for r in got}
    assert all(abs(share[k] - math.exp(-1) / math.factorial(k)) < 0.01 for k in range(4))


def _brute_knn(points, queries, k, first):
    out = {}
    for qid, qv, ql in queries:
        units = []
        own = False
        for pid, v, lab in points:
            d2 = sum((a - b) ** 2 for a, b in zip(v, qv))
            if not own and d2 == 0 and lab == ql:
                own = True                          # one unit of its own group is itself
                continue
            units.append((round(d2, 9), lab != first, lab))
        out[qid] = sorted(units)[:k]
    return out


@pytest.mark.parametrize("dims,seed", [(2, 1), (12, 2), (40, 3)])
def test_neighbours_in_many_dimensions(spark, dims, seed):
    rng = np.random.default_rng(seed)
    centers = rng.normal(0, 5, (6, dims))
    v = np.round(centers[rng.integers(0, 6, 500)] + rng.normal(0, 0.5, (500, dims)), 2)
    v[100:180] = v[7]                                # one location held by many rows
    lab = rng.integers(0, 2, 500)
    points = [(int(i), [float(x) for x in v[i]], int(lab[i])) for i in range(500)]
    df = spark.createDataFrame(points, "id long, v array<double>, lab int")
    asked = [p for p in points if p[0] % 7 == 0 or 98 <= p[0] < 110]
    hits, cost = cells.knn(df.where("id % 7 = 0 or id between 98 and 109"), df, "id", "v", "lab", 5, first_class=1, cell_points=32)
    got = {}
    for r in hits.collect():
        got.setdefault(r.qid, []).extend([(round(r.d2, 9), r.n_label != 1, r.n_label)] * r["take"])
    assert {q: sorted(u) for q, u in got.items()} == _brute_knn(points, asked, 5, 1)
    met = cost.agg(F.avg("met").alias("m"), F.count("qid").alias("n")).first()
    assert met.n == len(asked) and met.m < 0.6 * df.select("v", "lab").distinct().count()       # most cells are never met


def test_neighbour_edges(spark):
    rows = [(0, [0.0] * 9, 1), (1, None, 1), (2, [float("nan")] * 9, 0), (3, [1.0] * 9, 0), (4, [], 0)]
    df = spark.createDataFrame(rows, "id long, v array<double>, lab int")
    hits, cost = cells.knn(df, df, "id", "v", "lab", 3)
    assert sorted((r.qid, r.gid, r["take"], r.d2) for r in hits.collect()) == [(0, 3, 1, 9.0), (3, 0, 1, 9.0)]
    hits, cost = cells.knn(df.limit(0), df, "id", "v", "lab", 3)
    assert hits.count() == 0 and hits.columns == ["qid", "gid", "n_vec", "n_label", "take", "d2"] and cost.count() == 0
    with pytest.raises(ValueError, match="lengths"):
        cells.knn(df, df.unionByName(spark.createDataFrame([(9, [1.0], 0)], df.schema)), "id", "v", "lab", 1)


def test_parallel_start_is_reproducible_and_spreads(spark):
    rng = np.random.default_rng(0)
    centers = rng.normal(0, 40, (5, 6))
    rows = [(i, [float(x) for x in centers[i % 5] + rng.normal(0, 0.3, 6)]) for i in range(1000)] + [(5000, None), (None, [0.0] * 6)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    start = km.parallel_start(df, "id", "v", 5, steps=4)
    assert start == km.parallel_start(df.repartition(7), "id", "v", 5, steps=4)
    assert sorted(int(np.argmin(((centers - s) ** 2).sum(1))) for s in start) == [0, 1, 2, 3, 4]
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(50)], "id long, v array<double>")
    assert km.parallel_start(same, "id", "v", 3) == [[1.0, 2.0]]
    assert km.parallel_start(same.limit(0), "id", "v", 3) == []


def test_borderline_points_in_many_dimensions(spark):
    from kiln.operators import neighbors
    rng = np.random.default_rng(4)
    v = np.round(rng.normal(0, 1, (160, 12)), 2)
    lab = (rng.random(160) < 0.3).astype(int)
    v[lab == 1] += 0.4
    rows = [(int(i), [float(x) for x in v[i]], int(lab[i])) for i in range(160)]
    df = spark.createDataFrame(rows, "id long, v array<double>, lab int")
    got = {r.id: r.n_majority for r in neighbors.danger_points(df, "id", "v", "lab", 1, 0).collect()}
    want = {}
    for i, x, y in rows:
        if y == 1:
            near = sorted((sum((a - b) ** 2 for a, b in zip(x, w)), z != 0, j) for j, w, z in rows if j != i)[:5]
            want[i] = sum(not other for _, other, _ in near)
    assert got == want
    new = neighbors.borderline_smote(df, "id", "v", "lab", 1, 0)
    assert new.count() == sum(lab == 0) - sum(lab == 1) and all(len(r.v) == 12 for r in new.collect())
