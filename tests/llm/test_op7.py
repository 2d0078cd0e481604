"""Mixing: targets, near-exact quotas, disjoint blocks, the splitting tree."""
import random

import numpy as np
import pytest
from llm_helpers import words

from kiln.llm import mixing


def reshare(sizes, weights, cap=3):
    """Targets by repeated resharing."""
    out, free = [0.0] * len(sizes), set(range(len(sizes)))
    left = float(sum(sizes))
    while free:
        w = sum(weights[i] for i in free)
        over = {i for i in free if left * weights[i] / w > cap * sizes[i]}
        if not over:
            for i in free:
                out[i] = left * weights[i] / w
            break
        for i in over:
            out[i] = cap * sizes[i]
            left -= out[i]
        free -= over
    return out


def test_targets_equal_repeated_resharing():
    rng = random.Random(1)
    for _ in range(200):
        sizes = [rng.choice([0, 1, rng.randrange(1, 50), rng.randrange(1, 5000)]) for _ in range(rng.randrange(1, 9))]
        weights = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))]
        assert mixing.targets(sizes, weights) == pytest.approx(reshare(sizes, weights))


def test_splitting_tree_deals_exactly():
    for blocks in ([5, 0, 13], [1], [1000, 3, 77, 12]):
        dealt = mixing.split_quotas(blocks, 16, 3)
        assert dealt.sum(axis=0).tolist() == blocks and (dealt >= 0).all()
        per = dealt.sum(axis=1)
        assert per.max() - per.min() <= 2
    assert (mixing.split_quotas([40, 9], 8, 1) == mixing.split_quotas([40, 9], 8, 1)).all()


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 60)), rng.choice(["a", "a", "a", "b", "c", "é", None]), i, "s", "e")
            for i in range(1500)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, blocks long, _size string, epochs string")


def test_quotas(corpus, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 16)
    got = mixing.taken(corpus.repartition(5)).collect()
    again = mixing.taken(corpus.repartition(2)).collect()
    assert sorted(got) == sorted(again) and len(got) == 1500
    rows = {r.doc_id: r for r in corpus.collect()}
    by = {}
    for r in got:
        assert r.size == len(words(rows[r.doc_id].text)) and 0 <= r.taken <= 3 * r.size and r.taken % r.size == 0
        by.setdefault(rows[r.doc_id].source, []).append(r)
    names = sorted((s for s in by if s is not None), key=lambda s: s.encode()) + [None]
    sizes = [sum(r.size for r in by[s]) for s in names]
    want = mixing.targets(sizes, [mixing.WEIGHTS[i % 3] for i in range(len(names))])
    for s, size, t in zip(names, sizes, want):
        assert {r.source_size for r in by[s]} == {size} and {r.target for r in by[s]} == {t}
        assert abs(sum(r.taken for r in by[s]) - t) <= 30


def test_draws_are_disjoint_runs_of_blocks(corpus, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 16)
    plan = mixing.plan(corpus)
    taken = {r.doc_id: r.taken for r in mixing.taken(corpus).collect()}
    shards = set()
    for r in plan.collect():
        assert len(r["_shards"]) * r["_size"] == taken[r["_row"]["doc_id"]]
        assert all(0 <= s < mixing.OUT_SHARDS for s in r["_shards"]) and r["_shards"] == sorted(r["_shards"])
        shards |= set(r["_shards"])
    assert len(shards) == mixing.OUT_SHARDS
    mixed = mixing.mix(corpus)
    assert mixed.columns == corpus.columns
    rows = mixed.collect()
    assert len(rows) == sum(t // len(words(x.text)) for x in corpus.collect() for t in [taken[x.doc_id]])
    assert {(r["_size"], r.epochs) for r in rows} == {("s", "e")}


def test_the_tree_decides_what_is_drawn(corpus, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 16)
    asked = {}

    def kept(blocks, shards, seed, deal=mixing.split_quotas):
        asked["dealt"] = deal(blocks, shards, seed)
        return asked["dealt"]

    monkeypatch.setattr(mixing, "split_quotas", kept)
    rows = mixing.draws(corpus).collect()
    # every source's blocks in a shard are as many as the tree dealt (a block without rows shows none)
    seen = {}
    for r in rows:
        seen[r["_shard"]] = seen.get(r["_shard"], 0) + 1
    dealt = asked["dealt"].sum(axis=1)
    assert set(seen) == {i for i, n in enumerate(dealt) if n}
    assert max(seen.values()) < 2 * len(rows) / mixing.OUT_SHARDS
    monkeypatch.setattr(mixing, "split_quotas", lambda blocks, shards, seed: np.zeros((shards, len(blocks)), np.int64))
    assert sum(r.taken for r in mixing.taken(corpus).collect()) == 0

    def last_only(blocks, shards, seed):
        out = np.zeros((shards, len(blocks)), np.int64)
        out[-1] = blocks
        return out

    monkeypatch.setattr(mixing, "split_quotas", last_only)
    assert {r["_shard"] for r in mixing.draws(corpus).collect()} == {mixing.OUT_SHARDS - 1}


def test_big_shards_are_cut_into_parts(corpus, monkeypatch):
    whole = mixing.mix(corpus)
    assert whole.rdd.getNumPartitions() == mixing.OUT_SHARDS
    monkeypatch.setattr(mixing, "PART_BYTES", 2000)
    rows = mixing.draws(corpus)
    parts = rows.rdd.getNumPartitions()
    got = rows.rdd.mapPartitions(lambda it: [[(r["_shard"], r["_part"], r["_local"]) for r in it]]).collect()
    assert parts > 2 * mixing.OUT_SHARDS and parts % mixing.OUT_SHARDS == 0
    for i, p in enumerate(got):
        assert {s * (parts // mixing.OUT_SHARDS) + n for s, n, _ in p} <= {i}
        assert [x[2] for x in p] == sorted(x[2] for x in p)
    assert sorted(whole.collect(), key=str) == sorted(mixing.mix(corpus).collect(), key=str)


def test_edge_cases(spark, docs, no_docs):
    got = mixing.taken(docs).collect()
    assert len(got) == docs.count()
    assert all(r.taken == 0 for r in got if r.doc_id in (5, 6, 10))
    total = sum(r.size for r in got)
    by_source = {(r.source_size, r.target) for r in got}
    assert sum(t for _, t in by_source) == pytest.approx(total) and all(r.taken <= 3 * r.size for r in got)
    assert mixing.taken(no_docs).count() == 0 and mixing.mix(no_docs).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in mixing.taken(blank).collect()] == [(0, 0.0, 0)] * 2
    assert np.isfinite([r.target for r in got]).all()
