"""Hand-made cases with known answers (FIXTURES.md section 3)."""

import math

import pytest
from pyspark.sql import functions as F

from kiln.functions import arrays as A
from kiln.functions import numeric as N
from kiln.functions import strings as S
from kiln.operators import evaluate as ev
from kiln.operators import kmeans as km
from kiln.operators import naive_bayes as nb
from kiln.operators import sequence as seq
from kiln.operators import split as sp
from kiln.operators import stats as st
from kiln.operators import text as tx
from kiln.streaming.microbatch_kmeans import STATE, decayed


def test_word_count_a1(spark):
    df = spark.createDataFrame([("the cat hissed at the dog",)], "text string")
    got = {r["word"]: r["n"] for r in st.word_count(df).collect()}
    assert got == {"the": 2, "cat": 1, "hissed": 1, "at": 1, "dog": 1}


def _pairs(spark):
    rows = [(0, 0)] * 3 + [(1, 0)] + [(1, 1)] * 2 + [(0, 1)]
    return spark.createDataFrame(rows, "label int, prediction int")


def test_confusion_metrics_e2_e3_e4(spark):
    conf = ev.confusion(_pairs(spark), [0, 1])
    grid = {(r["label"], r["prediction"]): r["n"] for r in conf.collect()}
    assert grid == {(0, 0): 3, (0, 1): 1, (1, 0): 1, (1, 1): 2}
    m = ev.classification_metrics(conf, positive=1).first()
    assert m["accuracy"] == pytest.approx(5 / 7)
    assert m["f1_weighted"] == pytest.approx(5 / 7)
    assert m["f1_positive"] == pytest.approx(2 / 3)


def test_confusion_matches_library_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    df = _pairs(spark).select(F.col("label").cast("double"), F.col("prediction").cast("double"))
    lib = MulticlassClassificationEvaluator(metricName="f1").evaluate(df)
    ours = ev.classification_metrics(ev.confusion(df, [0.0, 1.0]), positive=1.0).first()
    assert ours["f1_weighted"] == pytest.approx(lib)


def _nb_data(spark):
    rows = [(0, 0, [1.0, 0.0, 2.0]), (1, 0, [3.0, 1.0, 0.0]), (2, 0, [0.0, 1.0, 1.0]),
            (3, 1, [0.0, 5.0, 1.0])]
    df = spark.createDataFrame(rows, "id int, label int, x array<double>")
    feats = df.select("id", "label", F.posexplode("x").alias("j", "x")) \
        .select("id", "label", F.format_string("f%d", "j").alias("word"), "x")
    return df, feats


def test_naive_bayes_l1_theta_and_prior(spark):
    df, feats = _nb_data(spark)
    m = nb.train(feats, df.select("id", "label"), alpha=0.1)
    th = {(r["label"], r["word"]): r["theta"] for r in m.theta.collect()}
    assert th[(0, "f0")] == pytest.approx(-0.819027, abs=1e-6)
    assert th[(0, "f1")] == pytest.approx(-1.488077, abs=1e-6)
    assert th[(0, "f2")] == pytest.approx(-1.098612, abs=1e-6)
    pi = {r["label"]: r["pi"] for r in m.prior.collect()}
    assert pi[0] == pytest.approx(math.log(3 / 4))
    assert pi[1] == pytest.approx(math.log(1 / 4))


def test_naive_bayes_l1_vs_library_l4(spark):
    """theta agrees with the library; the library smooths the prior too."""
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.functions import array_to_vector
    df, feats = _nb_data(spark)
    ours = nb.train(feats, df.select("id", "label"), alpha=0.1)
    lib = NaiveBayes(smoothing=0.1, modelType="multinomial").fit(
        df.select(F.col("label").cast("double"), array_to_vector("x").alias("features")))
    th = {(r["label"], r["word"]): r["theta"] for r in ours.theta.collect()}
    for c in (0, 1):
        for j in range(3):
            assert th[(c, f"f{j}")] == pytest.approx(lib.theta.toArray()[c][j], abs=1e-9)
    assert lib.pi.toArray()[0] == pytest.approx(math.log(3.1 / 4.2), abs=1e-6)
    assert lib.pi.toArray()[1] == pytest.approx(math.log(1.1 / 4.2), abs=1e-6)


def test_naive_bayes_scoring_matches_library(spark):
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.functions import array_to_vector
    df, feats = _nb_data(spark)
    ours = nb.train(feats, df.select("id", "label"), alpha=0.1)
    pred = {r["id"]: r["prediction"] for r in nb.score(ours, feats, df.select("id", "label"), "id").collect()}
    lib = NaiveBayes(smoothing=0.1).fit(df.select(F.col("label").cast("double"),
                                                  array_to_vector("x").alias("features")))
    # same theta; the unsmoothed prior can only differ on near ties -- none here
    lp = {r["id"]: int(r["prediction"]) for r in lib.transform(
        df.select("id", F.col("label").cast("double"), array_to_vector("x").alias("features"))).collect()}
    assert pred == lp


def test_naive_bayes_rejects_negative(spark):
    df = spark.createDataFrame([(0, 0, "a", -1.0)], "id int, label int, word string, x double")
    with pytest.raises(Exception):
        nb.train(df, df.select("id", "label"))


def test_index_and_onehot_m3_m4(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    from kiln.operators.features import index_and_encode
    df = spark.createDataFrame([(0, "a"), (1, "b"), (2, "a"), (3, None)], "id int, c string")
    out = Pipeline(stages=index_and_encode(["c"])).fit(df).transform(df) \
        .select("id", "c_idx", vector_to_array("c_vec").alias("v")).orderBy("id").collect()
    assert [r["c_idx"] for r in out] == [0.0, 1.0, 0.0, 2.0]
    assert all(len(r["v"]) == 3 for r in out)


def test_std_flavours_a11_a12(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (0.0,), (0.0,)], "x double")
    pop = st.moments(df, ["x"], ddof=0).first()
    samp = st.moments(df, ["x"], ddof=1).first()
    assert samp["x_std"] == pytest.approx(1.414214, abs=1e-6)
    assert pop["x_std"] == pytest.approx(1.224745, abs=1e-6)


def test_quantise_half_even_x12(spark):
    df = spark.createDataFrame([(0.0625,), (0.1875,), (0.3125,)], "x double")
    got = [r[0] for r in df.select(N.quantise("x", 0.125)).collect()]
    assert got == [0.0, 0.25, 0.25]


def test_steps_and_running_time_w1_w4(spark):
    notes = spark.createDataFrame([(1, float(s), 0.5, "p", i) for i, s in enumerate([0, 1, 1.5, 3])],
                                  "seq_id int, start double, duration double, pitch string, event_id int")
    s = seq.steps(notes)
    assert [r["step"] for r in s.orderBy("pos").collect()] == [1.0, 0.5, 1.5]
    r = seq.running_time(s).orderBy("pos").collect()
    assert [x["abs_start"] for x in r] == [1.0, 1.5, 3.0]


def test_sliding_windows_w3(spark):
    rows = spark.createDataFrame([(1, p, float(p)) for p in range(1, 6)], "seq_id int, pos int, step double")
    w = seq.sliding_windows(rows, 2, fields=("step",)).orderBy("window_start").collect()
    assert [(list(r["in_step"]), r["target_step"]) for r in w] == \
        [([1.0, 2.0], 3.0), ([2.0, 3.0], 4.0), ([3.0, 4.0], 5.0)]


def test_sliding_windows_cross_chunks(spark):
    """Windows spanning a chunk boundary come out once each (halo rows)."""
    n, length = 57, 5
    rows = spark.createDataFrame([(1, p, float(p)) for p in range(1, n + 1)], "seq_id int, pos int, step double")
    w = seq.sliding_windows(rows, length, fields=("step",), chunk=8).collect()
    assert len(w) == n - length
    assert sorted(r["window_start"] for r in w) == list(range(1, n - length + 1))
    assert all(list(r["in_step"]) == [float(r["window_start"] + i) for i in range(length)] for r in w)


def test_largest_remainder_w6(spark):
    counts = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "k string, n long")
    got = {r["k"]: r["quota"] for r in sp.largest_remainder(counts, "k", "n", 10).collect()}
    assert got == {"a": 4, "b": 3, "c": 3}


def test_exact_split_w8(spark):
    df = spark.range(518).withColumnRenamed("id", "rid")
    got = {r["split"]: r["count"] for r in sp.exact_fraction_split(df, "rid", 0.8).groupBy("split").count().collect()}
    assert got == {"train": 414, "val": 104}


def test_parse_answer_x3_x8(spark):
    vals = ["[3]", "$7$", "5.0", "2.5", "-4", "abc", "12times 10^3", "1d"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(S.parse_nonneg_int("v")).collect()]
    assert got == [3, 7, 5, None, None, None, 12, None]


def test_shift_left_x22(spark):
    df = spark.createDataFrame([([5, 6, 7],), ([],)], "a array<bigint>")
    got = [list(r[0]) for r in df.select(A.shift_left("a")).collect()]
    assert got == [[6, 7, -100], [-100]]


def test_chunks_x23(spark):
    """max 6, overlap 2, answer of 1 token, 10 prompt tokens: chunks start at
    0, 3, 6 and each ends with the answer; the last is padded to 6."""
    words = " ".join(f"w{chr(97 + i)}" for i in range(10))
    df = spark.createDataFrame([(1, words, "ans")], "id int, p string, a string")
    ch = tx.chunk(df, "id", "p", "a", max_len=6, overlap=2).orderBy("chunk_index").collect()
    ids = [tx_id for tx_id in spark.createDataFrame([(words,)], "p string")
           .select(tx.token_ids("p")).first()[0]]
    ans = spark.createDataFrame([("ans",)], "a string").select(tx.token_ids("a")).first()[0]
    assert [list(r["input_ids"]) for r in ch] == [ids[0:5] + ans, ids[3:8] + ans, ids[6:10] + ans + [0]]
    assert list(ch[-1]["attention_mask"]) == [1, 1, 1, 1, 1, 0]
    assert [r["n_real"] for r in ch] == [6, 6, 5]


def test_token_offsets_x25(spark):
    df = spark.createDataFrame([(1, "Hé, wörld!  ok", "x")], "id int, p string, a string")
    r = tx.chunk(df, "id", "p", "a", with_spans=True).first()
    assert list(r["offset_start"]) == [0, 2, 4, 9, 12, 0]
    assert list(r["offset_end"]) == [2, 3, 9, 10, 14, 1]


def test_argmax_x19(spark):
    df = spark.createDataFrame([([0.1, 0.7, 0.7],)], "a array<double>")
    assert df.select(A.argmax("a")).first()[0] == 1


def test_nearest_tie_lowest_j2(spark):
    df = spark.createDataFrame([([1.0],)], "v array<double>")
    assert km.assign(df, "v", [[0.0], [2.0]]).first()["cluster"] == 0


def test_decayed_update_t2(spark):
    def after(c, w, *stats):
        state = spark.createDataFrame([(0, [c], w)], STATE)
        seen = spark.createDataFrame([(0, n, [m]) for n, m in stats], "cluster int, n long, centroid array<double>")
        r = decayed(state, seen, 0.5).first()
        return r.centroid[0], r.weight
    assert after(0.0, 0.0, (2, 2.0)) == (2.0, 2.0)
    assert after(2.0, 2.0, (1, 5.0)) == (3.5, 2.0)
    assert after(3.5, 2.0) == (3.5, 1.0)        # absent cluster only decays


def test_dedup_keep_first_w7(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None)], "id int, text string")
    assert sorted(r["id"] for r in sp.dedup_keep_first(df, ["text"], "id").collect()) == [1, 3]


def test_ratio_ties_to_later_feature_o1(spark):
    rows = spark.createDataFrame([(1, 1), (2, 0)], "id int, label int")
    feats = spark.createDataFrame(
        [(1, 1, "w3", 2.0), (2, 0, "w3", 1.0), (1, 1, "w7", 4.0), (2, 0, "w7", 2.0),
         (1, 1, "w1", 1.0), (2, 0, "w1", 1.0)], "id int, label int, word string, x double")
    top = [r["word"] for r in nb.spam_word_ratio(feats, rows, top=2).collect()]
    assert top == ["w7", "w3"]


def test_regression_metrics_e5(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 4.0)], "label double, prediction double")
    m = ev.regression_metrics(df).first()
    assert m["rmse"] == pytest.approx(0.577350, abs=1e-6)
    assert m["r2"] == pytest.approx(0.5)


def test_auc_exact_e1(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.4, 1), (0.8, 1)], "score double, label int")
    assert ev.auc_exact(df).first()["auc"] == pytest.approx(0.875)


def test_ols_recovers_line_l12(spark):
    from kiln.sources.io import synthetic_line
    df = synthetic_line(spark, n=100, noise=1.0, seed=42)
    r = st.ols(df, "y", "x").first()
    assert r["slope"] == pytest.approx(3.0, abs=0.1)
    assert r["intercept"] == pytest.approx(1.0, abs=0.5)
