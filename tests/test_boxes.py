"""Neighbours by boxes: whatever the rows look like, a few steps and no side of a join in the driver."""
import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.operators import neighbors
from kiln.plans import q_synth


def _brute(points, asked, k, first):
    """Units (d2, rank, label) of the k nearest of each id that is asked."""
    groups, ids = collections.Counter(), {}
    for pid, lab, v in points:
        groups[tuple(v), lab] += 1
        ids[tuple(v), lab] = min(ids.get((tuple(v), lab), pid), pid)
    out = {}
    for qid, q_lab, q in asked:
        met = out.setdefault(qid, [])
        for (v, lab), w in groups.items():
            if [x is None for x in v] != [x is None for x in q]:
                continue
            d2 = -1.0 if None in v else 0.0                     # no distance: before all others
            for a, b in zip(q, v) if d2 == 0 else ():
                d2 += (a - b) * (a - b)
            units = (w - (v == tuple(q) and lab == q_lab)) * 3 ** v.count(None)
            met += [(d2, 2 if lab is None else int(lab != first), ids[v, lab], lab)] * min(units, k)
    return {q: [(d2, rank, lab) for d2, rank, _, lab in sorted(met, key=lambda x: x[:3])[:k]] for q, met in out.items()}


def _got(found):
    out = {}
    for r in found.collect():
        rank = 2 if r.n_label is None else int(r.n_label != 1)
        out.setdefault(r.qid, []).extend([(-1.0 if r.d2 is None else r.d2, rank, r.n_label)] * r["take"])
    return {q: sorted(units, key=str) for q, units in out.items()}


def test_neighbours_over_cells_pieces_and_blocks(spark, monkeypatch):
    boxes = pytest.importorskip("kiln.operators.boxes")
    for name, value in (("CELL_GROUPS", 16), ("MAX_CELLS", 16), ("QUERY_BLOCK", 8), ("SLICE_VALUES", 1 << 10), ("SLICE_ROWS", 50)):
        monkeypatch.setattr(boxes, name, value)
    rng = np.random.default_rng(7)
    v = np.round(np.abs(rng.standard_cauchy((500, 3))), 1)           # ties, and a few points far away
    v[:, 2] = rng.integers(0, 2, 500)
    v[100:220] = v[7]                                                # one location held by many rows
    lab = [None if i % 23 == 0 else int(rng.integers(0, 2)) for i in range(500)]
    points = [(i, lab[i], [float(x) for x in v[i]]) for i in range(500)]
    points += [(600 + i, i % 2, [None, float(i % 3), 1.0]) for i in range(9)] + [(620, 0, [None, None, 0.0]), (621, 0, [1.0, 2.0, None])]
    points += points[30:60]                                          # ids that come twice
    df = spark.createDataFrame(points, "id long, label int, v array<double>")
    more = spark.createDataFrame([(None, 0, [1.0, 1.0, 1.0]), (700, 0, None)], df.schema)   # asked without an id, or without a place
    found = neighbors.knn(df.where("label = 0").unionByName(more), df, "id", "v", "label", 5, first_class=1, max_cell_groups=20)
    assert found.dtypes == [("qid", "bigint"), ("n_vec", "array<double>"), ("n_label", "int"), ("take", "bigint"), ("d2", "double")]
    want = _brute(points, [p for p in points if p[1] == 0], 5, 1)
    assert _got(found) == {q: sorted(units, key=str) for q, units in want.items() if units}


def test_neighbours_of_points_that_are_not_finite(spark):
    nan, inf = math.nan, math.inf
    points = [(i, i % 2, [float(i), 0.0]) for i in range(4)] + [(10, 0, [nan, 0.0]), (11, 1, [inf, 1.0]), (12, 0, [inf, 2.0])]
    df = spark.createDataFrame(points, "id long, label int, v array<double>")
    got = {}
    for r in neighbors.knn(df, df, "id", "v", "label", 6, first_class=1).collect():
        got.setdefault(r.qid, []).extend([r.d2] * r["take"])
    assert {q: len(x) for q, x in got.items()} == dict.fromkeys([0, 1, 2, 3, 10, 11, 12], 6)
    kinds = {q: (sum(map(math.isnan, x)), sum(map(math.isinf, x))) for q, x in got.items()}
    assert kinds == {**dict.fromkeys(range(4), (1, 2)), 10: (6, 0), 11: (2, 4), 12: (2, 4)}


def test_distances_of_every_size_take_the_same_few_steps(spark):
    """Points from 1e-3 to 1e3 apart: rounds would follow the spread."""
    points = [(i, int(i % 5 > 0), [2.0 ** (i / 10), 0.001 * i, float(i % 2)]) for i in range(200)]
    df = spark.createDataFrame(points, "id long, label int, v array<double>")
    spark.sparkContext.setJobGroup("danger", "")
    try:
        got = {r.id: r.n_majority for r in neighbors.danger_points(df, "id", "v", "label", 0, 1).collect()}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    want = _brute(points, [p for p in points if p[1] == 0], 5, 1)
    assert got == {q: sum(lab == 1 for *_, lab in units) for q, units in want.items()}
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("danger")) < 80


def test_danger_points_broadcast_no_table(spark, tmp_path):
    rows = [(i, "word " * (i % 40), "en" if i % 3 else "de", (i * 37) % 400) for i in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(0, 200, 2)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    plan = q_synth._train(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [doc_id" in plan and "BroadcastHashJoin [doc_id" not in plan
    out = q_synth.q_smote_danger_points(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_majority", "danger"]
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.where(F.col("danger") != F.col("n_majority").isin(3, 4)).count() == 0 and out.count() == 35
