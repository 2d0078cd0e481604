"""Quantile tables against sorted values; the copula's marginals and correlations."""
import math

import numpy as np
import pytest

from kiln.operators import quantiles as qt
from kiln.operators import synth

NAN, INF = float("nan"), float("inf")


def columns(n=4000):
    rng = np.random.default_rng(3)
    return {
        "normal": rng.normal(size=n), "near": 1e9 + rng.normal(size=n) * 1e-3, "ties": rng.integers(0, 4, n).astype(float),
        "wide": rng.choice([-1.0, 1.0], n) * 10.0 ** rng.uniform(-300, 300, n),
        "hot": np.where(rng.random(n) < 0.4, 7.25, rng.gamma(2.0, size=n)), "one": np.full(n, -3.5),
        "zeros": rng.choice([-0.0, 0.0, 1e-320, -1e-320], n)}


@pytest.fixture(scope="module")
def frame(spark):
    data = columns()
    rows = [(int(i % 3) if i % 7 else None, *[float(v[i]) for v in data.values()]) for i in range(4000)]
    # values that take no part
    rows += [(0, *[x] * len(data)) for x in (None, NAN, INF, -INF)]
    return spark.createDataFrame(rows, "label int, " + ", ".join(f"{c} double" for c in data))


def by_class(frame):
    out = {}
    for r in frame.collect():
        for j, x in enumerate(r[1:]):
            if x is not None and math.isfinite(x):
                out.setdefault((r.label, j), []).append(x)
    return {k: np.sort(v) for k, v in out.items()}


def test_bits_keep_the_order():
    x = np.array([-1e308, -2.0, -1e-320, -0.0, 0.0, 1e-320, 1.0, 1.0000000000000002, 1e308])
    bits = qt.ordered_bits(x)
    assert (np.diff(bits.astype(object)) >= 0).all() and bits[3] == bits[4] and len(set(bits)) == 8


def test_cells_hold_few_rows_and_ranks_are_close(frame):
    cols = frame.columns[1:]
    want = by_class(frame)
    one = qt.coded(frame.coalesce(1), "label", cols)
    table = qt.quantile_cells(one, 64)
    again = qt.quantile_cells(qt.coded(frame.repartition(7), "label", cols), 64)
    assert table.start == again.start
    for f in ("n", "lo", "hi", "before", "total"):
        assert (getattr(table, f) == getattr(again, f)).all()
    assert one.classes == [None, 0, 1, 2]
    for i, c in enumerate(one.classes):
        for j in range(len(cols)):
            x, g = want[c, j], i * len(cols) + j
            a, b = table.start[g]
            assert table.n[a:b].sum() == len(x) == table.total[a]
            alike = table.lo[a:b] == table.hi[a:b]
            assert (alike | (table.n[a:b] * 64 <= len(x))).all()
            # the value at a rank is off by less than one cell's rows, either way
            u = (np.arange(len(x)) + 0.5) / len(x)
            got = table.values(g, u)
            low, high = np.searchsorted(x, got, "left"), np.searchsorted(x, got, "right")
            pos = np.arange(len(x))
            assert (np.maximum(low - pos, pos - high) <= len(x) / 64 + 1).all()
            mid = (np.searchsorted(x, x, "left") + np.searchsorted(x, x, "right") + 1) / 2
            assert (np.abs(table.ranks(g, x) * (len(x) + 1) - mid) <= len(x) / 64 + 1).all()
    assert np.isnan(table.ranks(0, np.array([NAN, INF, -INF]))).all()


def test_exact_quantiles(frame):
    cols, probs = frame.columns[1:], [0.0, 0.01, 0.5, 0.75, 1.0]
    want = by_class(frame)
    got = {(r.label, r.j, r.prob): (r.n, r.value) for r in qt.exact_quantiles(frame.repartition(5), "label", cols, probs).collect()}
    assert got == {(c, j, p): (len(x), x[max(1, math.ceil(p * len(x))) - 1]) for (c, j), x in want.items() for p in probs}


def test_nothing_to_count(spark):
    none = spark.createDataFrame([], "label string, a double")
    assert qt.exact_quantiles(none, "label", ["a"], [0.5]).collect() == []
    out = synth.sample_copula(none.withColumn("id", none.a), "id", "label", ["a"], 5)
    assert out.columns == ["sid", "label", "a"] and out.collect() == []
    blank = spark.createDataFrame([(1, "x", None, 2.0), (2, None, 1.0, NAN)], "id int, label string, a double, b double")
    got = synth.sample_copula(blank, "id", "label", ["a", "b"], 4).collect()
    assert sorted((r.label or "", r.a, r.b) for r in got) == [("", 1.0, None)] * 2 + [("x", None, 2.0)] * 2


def test_numpy_scores_equal_the_column_form(spark):
    from pyspark.sql import functions as F
    p = np.r_[1e-9, np.linspace(0.001, 0.999, 301), 1 - 1e-9]
    rows = spark.createDataFrame([(i, float(x)) for i, x in enumerate(p)], "i int, p double")
    z = [r.z for r in rows.select("i", synth.norm_ppf(F.col("p")).alias("z")).orderBy("i").collect()]
    assert np.allclose(synth.normal_scores(p), z, rtol=0, atol=1e-9)
    assert np.allclose(synth.normal_cdf(synth.normal_scores(p)), p, rtol=0, atol=1e-4)


def test_copula_keeps_marginals_and_correlations(spark):
    rng = np.random.default_rng(5)
    n = 6000
    a = rng.normal(size=n)
    b = np.exp(0.8 * a + 0.6 * rng.normal(size=n))
    c = np.where(a + rng.normal(size=n) > 0, 1.0, 0.0)
    lab = rng.choice(2, n, p=[0.3, 0.7])
    src = spark.createDataFrame([(i, int(l), float(x + 5 * l), float(y), float(z)) for i, (l, x, y, z) in enumerate(zip(lab, a, b, c))],
                                "id int, label int, a double, b double, c double")
    out = synth.sample_copula(src, "id", "label", ["a", "b", "c"], 12000, seed=2).toPandas()
    real = src.toPandas()
    for k in (0, 1):
        x, y = real[real.label == k], out[out.label == k]
        assert abs(len(y) / 12000 - len(x) / n) < 1e-3
        for col in "abc":
            grid = np.unique(x[col])
            d = np.searchsorted(np.sort(x[col]), grid, "right") / len(x) - np.searchsorted(np.sort(y[col]), grid, "right") / len(y)
            assert np.abs(d).max() < 0.03          # distance of the two distribution functions
        for p, q in (("a", "b"), ("a", "c"), ("b", "c")):     # c has two values: ties are corrected for
            assert abs(x[[p, q]].rank().corr().iloc[0, 1] - y[[p, q]].rank().corr().iloc[0, 1]) < 0.04
    assert set(out.c) == {0.0, 1.0}
