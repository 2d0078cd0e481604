"""The pipeline's stages, each against what its operator says of its input."""
import random

import pytest
from llm_helpers import brute_components, prose, words
from pyspark.sql import functions as F

import corpus_pipeline as P
from kiln.llm import phrase_index, setsketch, toxicity


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(3)
    d = str(tmp_path_factory.mktemp("pipe"))
    rows = []
    for i in range(240):
        w = prose(i + 50, rng.randrange(30, 80)).split()
        toxic = i % 4 == 0
        for _ in range(len(w) // 8 if toxic else 0):
            w[rng.randrange(len(w))] = rng.choice(["grumblefink", "snarkvessel"])
        rows.append((i, " ".join(w), "en", rng.choice(["a", "b", None]), 0, int(toxic)))
    item = " ".join(f"bench{j}" for j in range(14))
    rows += [(300 + j, rows[1][1] + " tail" * j, "en", "a", 0, 0) for j in range(4)]
    rows += [(400, prose(7, 20) + " " + item, "en", "b", 0, 0), (401, prose(8, 20) + " " + item[:40], "en", "b", 0, 0),
             (402, None, None, None, None, 0), (403, "", "en", "a", 0, 0), (404, prose(9, 40), "en", "a", 0, 0),
             (404, prose(9, 40), "en", "a", 0, 0), (405, prose(10, 40), "en", "a", 0, 0), (405, prose(11, 40), "en", "a", 0, 0),
             (405, prose(12, 20) + " " + item, "en", "a", 0, 0), (None, prose(13, 40), "en", "a", 0, 0),
             (None, prose(13, 40) + " x", "en", "a", 0, 0), (None, prose(14, 20) + " " + item, "en", "b", 0, 0)]
    spark.createDataFrame([r[:5] for r in rows], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(r[0], 1, r[5]) for r in rows[:240]], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    kept = {}
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, folder)
        out.write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == columns
        kept[name] = [r.asDict() for r in docs.collect()]
        # rows of id 405 are unlike texts, rows without an id are documents too
        odd = sorted(r.get("text") or "" for r in kept[name] if r["doc_id"] in (405, None))
        if name == "minhash_near_dedup":
            assert len(odd) == 5 and len({t[:60] for t in odd}) == 5
        elif name == "benchmark_decontamination":
            assert len(odd) == 3 and not any("bench3" in t for t in odd)
        ids = sorted(r["doc_id"] for r in kept[name] if r["doc_id"] not in (405, None))
        was = {r.doc_id: r.text for r in before.collect() if r.doc_id not in (405, None)}
        if name == "toxicity":
            model = toxicity.train(before, spark.read.parquet(f"{folder}/labels.parquet"))
            scored = toxicity.score(before, model).where(F.col("score") < toxicity.THRESHOLD)
            assert ids == sorted(r.doc_id for r in scored.collect() if r.doc_id not in (405, None))
            assert sum(i % 4 == 0 for i in ids if i < 240) <= 6 and sum(i % 4 != 0 for i in ids if i < 240) >= 170
        elif name == "minhash_near_dedup":
            want = brute_components({d: t for d, t in was.items()})
            assert ids == sorted(set(want.values()))
            assert 300 not in ids and ids.count(404) == 1
        elif name == "benchmark_decontamination":
            assert ids == sorted(set(was) - {400})
        elif name == "mixing_sources":
            assert set(ids) <= set(was) and max(ids.count(i) for i in set(ids)) <= 3
            assert abs(sum(len(words(r["text"])) for r in kept[name]) - sum(len(words(t)) for t in was.values())) <= 600
        else:
            assert len(kept[name]) == len(kept["mixing_sources"])
            counts = [sum(r["shard"] == s for r in kept[name]) for s in range(40)]
            assert max(counts) - min(counts) <= 1
    got = sorted((r.doc_id or -1, r.shard, r.slot) for r in P.run(spark, folder).collect())
    assert got == sorted((r["doc_id"] or -1, r["shard"], r["slot"]) for r in kept["sharding"])


def test_stages_on_an_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_extra_columns_survive(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("_toxic", F.lit("mine")) \
        .withColumn("kept", F.lit(1)).withColumn("component_id", F.lit(2)).withColumn("dealt", F.lit(3))
    for _, stage in P.STAGES[:4]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        assert out.where("_toxic <> 'mine' or kept <> 1 or component_id <> 2 or dealt <> 3").count() == 0


def test_stage_list():
    assert [n for n, _ in P.STAGES] == ["toxicity", "minhash_near_dedup", "benchmark_decontamination", "mixing_sources",
                                       "sharding"]
    assert setsketch.MIN_PERCENT == 75 and phrase_index.WINDOW == 10
