"""Softmax takes a number of steps in proportion to the array's length."""
import time

import numpy as np

from kiln.functions.arrays import softmax


def test_long_arrays_and_nulls(spark):
    rows = [(i, [float((i * j) % 97) for j in range(1500)]) for i in range(20)] + [(20, None), (21, []), (22, [None, 1.0]), (23, [2.0])]
    df = spark.createDataFrame(rows, "id long, a array<double>")
    began = time.time()
    got = {r.id: r.p for r in df.select("id", softmax("a", 0.5).alias("p")).collect()}
    assert time.time() - began < 60             # the cube of 1,500 steps takes hours
    for i, a in rows[:20]:
        e = np.exp((np.array(a) - max(a)) / 0.5)
        assert np.allclose(got[i], e / e.sum())
    assert got[20] is None and got[21] == [] and got[22] == [None, None] and got[23] == [1.0]
