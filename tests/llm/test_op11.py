import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.llm import voronoi

LOW, HIGH = -2 ** 63, 2 ** 63 - 1


def brute(rows, k=5, every=50):
    out = []
    for i, (a, x) in enumerate(rows):
        if a is None or a % every or x is None:
            continue
        scored = []
        for j, (b, y) in enumerate(rows):
            if i != j and y is not None:
                dot = sum(u * v for u, v in zip(x, y))         # shorter vectors: padded with zeros
                scored.append((-max(LOW, min(HIGH, dot)), b is None, b or 0, b))
        out += [(a, r, t[3], -t[0]) for r, t in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def found(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    return sorted(map(tuple, voronoi.top_k(df, F.col("vec_id") % 50 == 0, **kw).collect()), key=repr)


def test_ties_copies_repeated_ids_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-50, 50, 6).tolist()) for i in range(300)]
    rows += [(100, rows[100][1]), (100, [1, 2, 3, 4, 5, 6]), (None, [9] * 6), (None, [9] * 6), (7, None),
             (50, []), (150, [3]), (200, [2 ** 62] * 6), (1000, [-2 ** 62] * 6)]
    rows += [(1000 + i, [30] * 6) for i in range(200)]         # one vector held by a large share of the rows
    assert found(spark, rows, cell_rows=64, group_rows=4) == brute(rows)


def test_clusters_are_pruned_and_nothing_is_lost(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centers = rng.integers(-2000, 2000, (20, 8))
    rows = [(i, (centers[i % 20] + rng.integers(-5, 5, 8)).tolist()) for i in range(2000)]
    met, plain = [], voronoi._meet

    def counted(queries, data, width, k):
        met.append(data.count())
        return plain(queries, data, width, k)
    monkeypatch.setattr(voronoi, "_meet", counted)
    assert found(spark, rows, cell_rows=64, group_rows=4) == brute(rows)
    assert len(met) == 1 or met[1] < 3 * len(rows)             # of up to 10 groups x 2,000 rows


def test_few_rows_no_query_and_no_rows(spark):
    assert found(spark, [(0, [1, 2]), (50, [1, 2]), (50, [1, 2])]) == brute([(0, [1, 2]), (50, [1, 2]), (50, [1, 2])])
    assert found(spark, [(50, [1, 2])]) == []
    assert found(spark, [(1, [1, 2]), (2, [1, 2])]) == []
    assert found(spark, []) == []


def test_vectors_that_take_no_part_and_other_columns(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.001], "a"), (1, None, "b"), (2, [1.0, None], None), (3, [nan, 1.0], "c"), (4, [inf, 1.0], "d"),
            (5, [0.25, 1.0], "e"), (None, [1.0, 1.0], "f"), (50, [-1.0, 0.004], "g")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = sorted(map(tuple, voronoi.embedding_neighbours(df).collect()))
    assert got == sorted(brute([(r[0], [int(np.floor(256 * np.float64(np.float32(x)))) for x in r[1]])
                                for r in rows if r[0] not in (1, 2, 3, 4)]))


@pytest.mark.parametrize("k", [1, 3])
def test_upper_bounds_hold(k):
    rng = np.random.default_rng(k)
    v, q = rng.integers(-99, 99, (300, 7)), rng.integers(-99, 99, (40, 7))
    pivots = v[:9].astype(float)
    cell = voronoi.nearest(v, pivots)
    along, rest = voronoi.extent(v, pivots[cell])
    low, high, far = (np.array([f(x[cell == c]) for c in range(9)]) for f, x in ((np.min, along), (np.max, along), (np.max, rest)))
    bound, score = voronoi.upper(q, pivots, low, high, far), voronoi.inner(q, v)
    assert all((score[:, cell == c] <= bound[:, [c]]).all() for c in range(9))
