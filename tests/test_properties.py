"""Properties: exact split sizes, skew-safe scans equal plain windows,
repartition invariance, chunk coverage, k-means convergence."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kiln.operators import kmeans as km
from kiln.operators import split as sp
from kiln.operators import text as tx
from kiln.operators.ordered import ordered_scan


def _skewed(spark, n=3000):
    """One group holds half the rows (a hot key)."""
    return spark.range(n).select(
        F.col("id").alias("rid"),
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string")))
        .alias("grp"),
        (F.rand(1) * 100).alias("v"))


def test_ordered_scan_equals_window(spark):
    df = _skewed(spark)
    got = ordered_scan(df, [F.col("v"), F.col("rid")], F.floor(F.col("v") / 3), ["grp"],
                       carry=["v"], sums=["v"], rank_col="rk", size_col="n")
    w = Window.partitionBy("grp").orderBy("v", "rid")
    ref = df.select("rid", F.row_number().over(w).alias("rk_ref"),
                    F.lag("v").over(w).alias("prev_ref"),
                    F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum_ref"),
                    F.count("*").over(Window.partitionBy("grp")).alias("n_ref"))
    j = got.join(ref, "rid").collect()
    assert len(j) == 3000
    for r in j:
        assert r["rk"] == r["rk_ref"] and r["n"] == r["n_ref"]
        assert (r["prev_v"] is None and r["prev_ref"] is None) or r["prev_v"] == r["prev_ref"]
        assert r["cum_v"] == pytest.approx(r["cum_ref"])


def test_stratified_split_exact_per_class(spark):
    df = _skewed(spark)
    s = sp.stratified_split(df, "rid", "grp", 0.7, seed=3)
    sizes = {(r["grp"], r["split"]): r["count"] for r in s.groupBy("grp", "split").count().collect()}
    totals = {r["grp"]: r["count"] for r in df.groupBy("grp").count().collect()}
    for g, n in totals.items():
        assert sizes.get((g, "train"), 0) == int(0.7 * n)
        assert sizes.get((g, "train"), 0) + sizes.get((g, "test"), 0) == n


def test_splits_stable_under_repartition(spark):
    df = _skewed(spark)
    a = {r["rid"]: r["split"] for r in sp.exact_fraction_split(df, "rid", 0.8, seed=1).collect()}
    b = {r["rid"]: r["split"] for r in sp.exact_fraction_split(df.repartition(7), "rid", 0.8, seed=1).collect()}
    assert a == b
    h1 = {r["rid"]: r["split"] for r in sp.hash_split(df, "rid", 0.8, seed=5).collect()}
    h2 = {r["rid"]: r["split"] for r in sp.hash_split(df.repartition(7), "rid", 0.8, seed=5).collect()}
    assert h1 == h2


def test_fixed_batches_sizes(spark):
    df = spark.range(1000).withColumnRenamed("id", "rid")
    b = sp.fixed_batches(df, "rid", 64)
    counts = sorted(r["count"] for r in b.groupBy("batch_id").count().collect())
    assert counts == [40] + [64] * 15


def test_percent_split_contiguous(spark):
    df = spark.range(0, 1000, 3).withColumnRenamed("id", "rid")
    s = sp.percent_split(df, "rid", 0.7).collect()
    train = sorted(r["rid"] for r in s if r["split"] == "train")
    test = sorted(r["rid"] for r in s if r["split"] == "test")
    assert len(train) == int(0.7 * len(s)) and max(train) < min(test)


def test_dedup_with_hot_key(spark):
    df = _skewed(spark).select("rid", F.col("grp").alias("text"))
    kept = sorted(r["rid"] for r in sp.dedup_keep_first(df, ["text"], "rid").collect())
    ref = sorted(r[1] for r in df.groupBy("text").agg(F.min("rid")).collect())
    assert kept == ref


def test_chunks_cover_all_tokens(spark):
    text = " ".join(f"t{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(1000))
    df = spark.createDataFrame([(1, text, "a b")], "id int, p string, a string")
    ch = tx.chunk(df, "id", "p", "a", max_len=64, overlap=16).orderBy("chunk_index").collect()
    ids = spark.createDataFrame([(text,)], "p string").select(tx.token_ids("p")).first()[0]
    budget, step = 62, 46
    covered = []
    for r in ch:
        body = list(r["input_ids"])[: r["n_real"] - 2]
        start = r["chunk_index"] * step
        assert body == ids[start: start + budget]
        covered.extend(range(start, start + len(body)))
    assert set(covered) == set(range(len(ids)))
    assert ch[-1]["chunk_index"] * step + budget >= len(ids)


def test_chunk_rejects_long_answer(spark):
    df = spark.createDataFrame([(1, "x y z", " ".join(["q"] * 60))], "id int, p string, a string")
    assert tx.chunk(df, "id", "p", "a", max_len=64, overlap=16).count() == 0
    assert tx.rejected_rows(df, "id", "p", "a", max_len=64, overlap=16).count() == 1


def test_kmeans_fit_separated_clusters(spark):
    rows = [([float(c * 10 + (i % 3) * 0.1), float(c * 10)],) for c in range(3) for i in range(30)]
    df = spark.createDataFrame(rows, "v array<double>")
    res = km.fit(df, "v", [[1.0, 1.0], [9.0, 11.0], [21.0, 19.0]], max_iter=20)
    assert sorted(res.counts.values()) == [30, 30, 30]
    assert res.movement[-1] <= 1e-6 or res.rounds < 20


def test_kmeans_nan_row_unassigned(spark):
    df = spark.createDataFrame([([float("nan")],), ([1.0],)], "v array<double>")
    got = [r["cluster"] for r in km.assign(df, "v", [[0.0], [2.0]]).collect()]
    assert None in got and 0 in got


def test_copula_quotas_and_support(spark):
    from kiln.operators import synth
    rows = [(i, i % 3, float(i % 17), float((i * 7) % 11)) for i in range(300)]
    src = spark.createDataFrame(rows, "id int, label int, a double, b double")
    out = synth.sample_copula(src, "id", "label", ["a", "b"], 1000, seed=1)
    got = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert got == {0: 334, 1: 333, 2: 333}
    src_vals = {(r["label"], r["a"], r["b"]) for r in src.collect()}
    labs = {lab: ({v[1] for v in src_vals if v[0] == lab}, {v[2] for v in src_vals if v[0] == lab})
            for lab in (0, 1, 2)}
    for r in out.collect():
        assert r["a"] in labs[r["label"]][0] and r["b"] in labs[r["label"]][1]


def test_grid_knn_matches_brute_force(spark):
    """Exact kNN with duplicates (a hot location) and an isolated point."""
    import random
    from kiln.operators import neighbors as nb
    rnd = random.Random(3)
    rows = [(i, rnd.randint(0, 1), [rnd.random() * 10, rnd.random() * 10]) for i in range(150)]
    rows += [(150 + i, i % 2, [5.0, 5.0]) for i in range(40)]          # 40 identical points
    rows += [(999, 0, [100.0, 100.0])]                                 # far away
    df = spark.createDataFrame(rows, "id long, label int, v array<double>")
    got = nb.knn(df.where("label = 0"), df, "id", "v", "label", 4, first_class=1)
    counts = {}
    for r in got.collect():
        counts.setdefault(r["qid"], [0, 0])[r["n_label"]] += r["take"]
    for qid, ql, qv in rows:
        if ql != 0:
            continue
        cand = sorted(((x[0] - qv[0]) ** 2 + (x[1] - qv[1]) ** 2, 0 if lab == 1 else 1, rid, lab)
                      for rid, lab, x in rows if rid != qid)[:4]
        want = [sum(1 for c in cand if c[3] == 0), sum(1 for c in cand if c[3] == 1)]
        assert counts[qid] == want, qid


def test_smote_balances_classes(spark):
    import random
    from kiln.operators import neighbors as nb
    rnd = random.Random(5)
    rows = [(i, 1, [rnd.gauss(0, 1), rnd.gauss(0, 1)]) for i in range(120)]
    rows += [(1000 + i, 0, [rnd.gauss(0.5, 1), rnd.gauss(0.5, 1)]) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, label int, v array<double>")
    syn = nb.borderline_smote(df, "id", "v", "label", 0, 1, k=2, m=5, seed=1).collect()
    assert len(syn) == 90
    xs = [r[0] for _, lab, r in rows if lab == 0]
    ys = [r[1] for _, lab, r in rows if lab == 0]
    for r in syn:
        assert r["label"] == 0 and min(xs) <= r["v"][0] <= max(xs) and min(ys) <= r["v"][1] <= max(ys)


def test_kmeans_patience_keeps_best(spark):
    """With patience the loop stops once SSE stops improving and keeps
    the best state seen."""
    rows = [([float(i % 7), float((i * 3) % 5)],) for i in range(60)]
    df = spark.createDataFrame(rows, "v array<double>")
    res = km.fit(df, "v", [[0.0, 0.0], [6.0, 4.0]], max_iter=30, tol=0.0, change_tol=-1.0,
                 patience=1, min_delta=1e9)
    assert res.rounds == 2 and len(res.sse) == 2


def _notes(spark, lengths):
    rows, eid = [], 0
    for seq, n in enumerate(lengths):
        for i in range(n):
            rows.append((seq, float(i * i) * 0.5, 0.25, "p", eid))
            eid += 1
    return spark.createDataFrame(rows, "seq_id int, start double, duration double, pitch string, event_id int")


def test_seed_slice_short_sequences_w5(spark):
    from kiln.operators import sequence as seq
    notes = _notes(spark, [60, 30, 10])      # long, shorter than skip+n, shorter than skip
    s = seq.seed_slice(notes, skip=25, n=25).collect()
    per = {}
    for r in s:
        per.setdefault(r["seq_id"], []).append(r)
    assert len(per[0]) == 25 and len(per[1]) == 5 and len(per[2]) == 10
    for rs in per.values():
        first = min(rs, key=lambda r: r["slice_pos"])
        assert first["slice_pos"] == 1 and first["step"] == 0.0


def test_running_time_restores_starts_w1_w4(spark):
    from kiln.operators import sequence as seq
    notes = _notes(spark, [40, 3])
    steps = seq.steps(notes, q_step=0.125, q_duration=0.125)
    back = {(r["seq_id"], r["pos"]): r["abs_start"] for r in seq.running_time(steps).collect()}
    for r in notes.collect():
        pos = r["event_id"] - (0 if r["seq_id"] == 0 else 40) + 1
        if pos > 1:   # start relative to the sequence's first note
            assert back[(r["seq_id"], pos)] == pytest.approx(r["start"])


def test_grid_knn_dense_cluster_bounded(spark):
    """A dense cluster of distinct points forces smaller cells; still exact."""
    import random
    from kiln.operators import neighbors as nb
    rnd = random.Random(11)
    rows = [(i, i % 2, [rnd.random() * 0.01, rnd.random() * 0.01]) for i in range(200)]   # dense
    rows += [(500 + i, i % 2, [rnd.random() * 100, rnd.random() * 100]) for i in range(50)]  # sparse
    df = spark.createDataFrame(rows, "id long, label int, v array<double>")
    got = nb.knn(df.where("label = 0"), df, "id", "v", "label", 3, first_class=1, max_cell_groups=16)
    counts = {}
    for r in got.collect():
        counts.setdefault(r["qid"], [0, 0])[r["n_label"]] += r["take"]
    for qid, ql, qv in rows:
        if ql != 0:
            continue
        cand = sorted(((x[0] - qv[0]) ** 2 + (x[1] - qv[1]) ** 2, 0 if lab == 1 else 1, rid, lab)
                      for rid, lab, x in rows if rid != qid)[:3]
        assert counts[qid] == [sum(1 for c in cand if c[3] == 0), sum(1 for c in cand if c[3] == 1)]


def test_nulls_keep_their_rows(spark):
    from kiln.operators import evaluate as ev
    from kiln.operators import sequence as sq
    from kiln.operators import split as sp
    rows = [(i, None if i % 4 == 0 else "ab"[i % 2]) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, label string")
    got = sp.stratified_split(df, "id", "label", 0.7).groupBy("label", "split").count().collect()
    assert {(r.label, r.split): r["count"] for r in got}[(None, "train")] == 17
    assert sum(r["count"] for r in got) == 100
    conf = ev.confusion(spark.createDataFrame([(0, 0), (1, 0), (2, 1), (None, 1)], "label int, prediction int"), [0, 1])
    m = ev.classification_metrics(conf).first()
    assert m["total"] == 4 and m["accuracy"] == 0.25
    notes = spark.createDataFrame([(1, p, p, None if p == 3 else 1.0, 0.0) for p in range(1, 7)],
                                  "seq_id long, pos long, pitch long, step double, duration double")
    win = {r.window_start: r for r in sq.sliding_windows(notes, 2).collect()}
    assert len(win) == 4 and win[1].target_step is None and win[2].in_step == [1.0, None]


def test_any_split_fraction(spark):
    from kiln.operators import split as sp
    df = spark.range(40_000).withColumnRenamed("id", "k")
    n = sp.hash_split(df, "k", 0.995).where("split = 'test'").count()
    assert 140 <= n <= 260


def test_copula_ties_do_not_line_up(spark):
    import numpy as np

    from kiln.operators.synth import sample_copula
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2, 600), rng.integers(0, 2, 600)
    src = spark.createDataFrame([(i, 0, float(x), float(y)) for i, (x, y) in enumerate(zip(a, b))],
                                "id long, label int, x double, y double")
    one = sample_copula(src, "id", "label", ["x", "y"], 2000, partitions=1).toPandas().sort_values("sid")
    two = sample_copula(src.repartition(3), "id", "label", ["x", "y"], 2000, partitions=5).toPandas().sort_values("sid")
    assert one[["sid", "x", "y"]].values.tolist() == two[["sid", "x", "y"]].values.tolist()
    assert abs(np.corrcoef(one.x, one.y)[0, 1] - np.corrcoef(a, b)[0, 1]) < 0.1


def test_copula_query_takes_all_dims_and_rows(spark, tmp_path, monkeypatch):
    import numpy as np

    from kiln.plans import q_kmeans
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 7))
    x[:, 6] = 0.9 * x[:, 0] + 0.4 * x[:, 6]
    rows = [(i, i % 2, [float(v) for v in r]) for i, r in enumerate(x)]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    monkeypatch.setattr(q_kmeans, "N_SYNTH", 500, raising=False)
    out = q_kmeans.q_copula_synth(spark, str(tmp_path)).toPandas()
    assert list(out.columns) == ["sid", "label", *[f"x{i}" for i in range(7)]] and sorted(out.sid) == list(range(600))
    assert abs(np.corrcoef(out.x0, out.x6)[0, 1] - np.corrcoef(x[:, 0], x[:, 6])[0, 1]) < 0.1


def test_knn_of_a_far_query(spark):
    from kiln.operators.neighbors import knn
    refs = spark.createDataFrame([(i, [float(i), 0.0], 0) for i in range(20)], "id long, v array<double>, label int")
    far = spark.createDataFrame([(900, [500.0, -300.0], 0), (901, [500.0, -300.0], 0)], "id long, v array<double>, label int")
    got = {}
    for r in knn(far, refs, "id", "v", "label", 2, exclude_self=False).collect():
        got.setdefault(r.qid, []).append(r.n_vec[0])
    assert {q: sorted(x) for q, x in got.items()} == {900: [18.0, 19.0], 901: [18.0, 19.0]}


def test_stream_state_adds_up_and_replays(spark, tmp_path):
    from kiln.streaming import microbatch_kmeans as mk
    rows = spark.createDataFrame([(i, [float(i % 3 * 10 + i % 2), 1.0]) for i in range(60)], "id long, v array<double>")
    path = str(tmp_path / "batches")
    mk.write_microbatches(rows, "id", 4, path)
    rows.withColumn("batch", F.lit(9)).limit(0).coalesce(1).write.parquet(f"{path}/00009")     # an empty batch
    res = mk.run(spark, path, rows.schema, "v", "id", 3, work_dir=str(tmp_path / "run"))
    assert mk.final_state(spark, res).agg(F.sum("weight")).first()[0] == 60.0
    counts = mk.batch_counts(spark, res).groupBy("batch_id").agg(F.sum("n").alias("n")).collect()
    assert [r.n for r in counts] == [15] * 4
    again = mk.run(spark, path, rows.schema, "v", "id", 3, work_dir=str(tmp_path / "again"))
    assert sorted(map(str, mk.final_state(spark, res).collect())) == sorted(map(str, mk.final_state(spark, again).collect()))


def test_stray_ids_do_not_fill_one_bucket(spark):
    from kiln.operators.split import id_range_bucket, id_rank
    df = spark.range(3000).select(F.col("id").alias("k")).unionByName(
        spark.createDataFrame([(2**61,), (-(2**61),)], "k long"))
    b = df.withColumn("b", id_range_bucket(df, "k", 1024))
    assert b.groupBy("b").count().agg(F.max("count")).first()[0] <= 120
    ranks = [r["_rank"] for r in id_rank(df, "k").orderBy("k").collect()]
    assert ranks == list(range(1, 3003))


def test_dedup_of_a_hot_key(spark):
    rows = [(i, "hot" if i % 3 else f"t{i}") for i in range(900)] + [(1000, None), (1001, None), (1002, "")]
    df = spark.createDataFrame(rows, "id long, text string").repartition(5)
    kept = sorted(r["id"] for r in sp.dedup_keep_first(df, ["text"], "id").collect())
    assert kept == sorted([1, 1000, 1002] + list(range(0, 900, 3)))
