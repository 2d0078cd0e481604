"""Distances to pivots and visits of cells are held in bounded slices."""
import numpy as np
import pyarrow as pa

from kiln.operators import cells


def test_slices_hold_a_bounded_number_of_values():
    batch = pa.RecordBatch.from_arrays([pa.array(range(10_000))], ["i"])
    parts = list(cells._slices(batch, 1024))
    assert max(p.num_rows for p in parts) * 1024 <= cells.SLICE_VALUES and len(parts) > 5
    assert [i for p in parts for i in p.column("i").to_pylist()] == list(range(10_000))
    assert [p.num_rows for p in cells._slices(batch.slice(0, 3), cells.SLICE_VALUES * 2)] == [1, 1, 1]
    assert list(cells._slices(batch.slice(0, 0), 5)) == []


def test_neighbours_over_several_slices(spark):
    rng = np.random.default_rng(5)
    v = np.round(rng.normal(0, 5, (40, 9))[rng.integers(0, 40, 5000)] + rng.normal(0, 0.2, (5000, 9)), 3)
    df = spark.createDataFrame([(i, [float(x) for x in v[i]], 0) for i in range(5000)], "id long, v array<double>, lab int").coalesce(1)
    hits, _ = cells.knn(df.where("id % 2 = 0"), df, "id", "v", "lab", 2, max_pivots=600, cell_points=32)
    got = {}
    for r in hits.collect():
        got.setdefault(r.qid, []).append(round(r.d2, 6))
    assert len(got) == 2500
    for q in range(0, 5000, 500):
        d2 = np.delete(((v - v[q]) ** 2).sum(1), q)
        assert np.allclose(sorted(got[q]), np.sort(d2)[:2], atol=1e-5)
