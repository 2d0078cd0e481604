"""Near-duplicates against brute force over full shingle sets."""
import random

import numpy as np
import pytest
from llm_helpers import brute_components, prose, shingles

from kiln.llm import setsketch
from kiln.llm.components import connected_components


def rows_of(df):
    return {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in df.collect()}


def test_edge_cases(docs):
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in setsketch.near_duplicates(docs).collect()]
    assert len(got) == docs.count()
    by = {d: (n, c, k) for d, n, c, k in got}
    assert by[1] == (56, 1, True) and by[2] == (56, 1, False) and by[3] == (59, 1, False)
    assert by[5] == (0, 5, True) and by[6] == (0, 6, True) and by[10] == (0, 10, True)
    assert by[8] == (1, 8, True) and by[9] == (1, 8, False) and by[11] == (1, 11, True)
    assert by[12][1:] == (4, False) and [x for x in got if x[0] == 12] == [(12, 76, 4, False)] * 2
    assert by[None] == (56, None, True)
    assert by[7][0] == len(shingles(docs.where("doc_id = 7").first().text))


def test_empty_table(no_docs):
    assert setsketch.near_duplicates(no_docs).count() == 0


def test_dense_group_equals_brute_force(spark):
    """A group of variants whose pairs lie on both sides of the threshold, so
    that many links do not run through the group's first document."""
    rng = random.Random(3)
    base = [f"a{i}" for i in range(120)]
    texts = {}
    for d in range(260):
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 4, 6, 8])):
            w[rng.randrange(len(w))] = f"z{rng.randrange(40)}"
        texts[d] = " ".join(w)
    for d in range(260, 320):
        texts[d] = " ".join(f"q{rng.randrange(10_000)}" for _ in range(rng.randrange(0, 90)))
    want = brute_components(texts)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(7)
    got = {r.doc_id: r.component_id for r in setsketch.near_duplicates(df).collect()}
    assert got == want


def test_blocks_of_a_large_bucket(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"a{i}" for i in range(60)]
    texts = {d: " ".join(w if rng.random() > 0.05 else f"z{rng.randrange(30)}" for w in base) for d in range(150)}
    monkeypatch.setattr(setsketch, "BLOCK", 16)
    monkeypatch.setattr(setsketch, "FEW", 0)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in setsketch.near_duplicates(df).collect()} == brute_components(texts)


def test_sketch_merges_and_estimates():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (900, 300))
    x, y = np.concatenate([a, b]), a
    assert (setsketch.merge(setsketch.sketch(a), setsketch.sketch(b)) == setsketch.sketch(np.sort(x))).all()
    kx, ky = setsketch.sketch(x), setsketch.sketch(y)
    est = setsketch.joint_similarity(np.array([(kx > ky).sum()]), np.array([(kx < ky).sum()]),
                                     np.array([len(x)]), np.array([len(y)]))
    assert est[0] == pytest.approx(0.75, abs=0.12)
    near = setsketch.comes_near(np.array([(kx > ky).sum()]), np.array([(kx < ky).sum()]),
                                np.array([len(x)]), np.array([len(y)]), level=float(est[0]) - 0.02)
    assert near[0]


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(200, 300)] + [(500, 3), (3, 500), (7, 7), (None, 1)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 200 for i in range(200, 301)}, 500: 3, 3: 3}


def test_one_of_each_tells_rows_apart(spark):
    base, other = prose(31, 60), prose(32, 60)
    rows = [(1, base, "a"), (1, other, "a"), (1, other, "b"), (2, base + " tail", "a"), (None, other, "a"), (None, prose(33, 50), "a"),
            (None, prose(33, 50), "b"), (None, prose(33, 50) + " more", "c"), (None, None, "a"), (None, "", "a"), (None, None, "b"),
            (3, "", "a"), (3, "", "b"), (4, None, "a"), (5, prose(34, 40), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _key string").repartition(4)
    got = setsketch.one_of_each(df)
    assert got.columns == df.columns
    out = sorted(map(tuple, got.collect()), key=str)
    free = [r for r in out if r[0] is None]
    assert [r for r in out if r[0] == 2] + [r for r in out if r[0] == 1 and r[1] == base] == [(2, base + " tail", "a")]
    assert [r for r in out if r[1] == other] == [(1, other, "a")]              # the row with an id stays
    assert sorted(r[2] for r in free if not r[1]) == ["a", "a", "b"] and len([r for r in free if r[1]]) == 1
    assert [r for r in out if r[0] in (3, 4, 5)] == [(3, "", "a"), (4, None, "a"), (5, prose(34, 40), None)]
    assert setsketch.one_of_each(df.limit(0)).count() == 0


def template_texts(n, rng, own=(14, 15)):
    """Texts of one template, each with words of its own in one place: pairs
    stay under the threshold."""
    base = [f"t{i}" for i in range(72)]
    return {d: " ".join(base + [f"own{d}x{k}" for k in range(rng.randint(*own))]) for d in range(n)}


def test_prefix_pairs_lose_no_link():
    rng = np.random.default_rng(4)
    for trial in range(60):
        base = rng.choice(400, 60, replace=False)
        sets, comp = [], []
        for r in range(40):
            keep = base[rng.random(60) > rng.choice([0, 0.02, 0.1, 0.2, 0.9])]
            sets.append(np.unique(np.concatenate([keep, rng.choice(400, rng.integers(1, 20))])).astype(np.uint64))
            comp.append(r if rng.random() < 0.7 else 0)
        n, comp = np.array([len(x) for x in sets]), np.array(comp)
        block = np.zeros(40, np.int64) if trial % 2 else rng.integers(0, 2, 40)
        setsketch.EXPAND, before = (50 if trial % 3 else 1 << 20), setsketch.EXPAND
        x, y = setsketch.prefix_pairs(np.concatenate(sets), n, comp, block)
        setsketch.EXPAND = before
        got = {tuple(sorted(p)) for p in zip(x.tolist(), y.tolist())}
        two = len(set(block.tolist())) > 1
        for i in range(40):
            for j in range(i):
                apart = comp[i] != comp[j] and (not two or block[i] != block[j])
                both = len(np.intersect1d(sets[i], sets[j]))
                close = 100 * both >= 75 * (n[i] + n[j] - both)
                assert setsketch._similar(sets[i], sets[j]) == close
                assert not (apart and close) or (j, i) in got
                assert apart or (j, i) not in got


def test_texts_of_one_template_make_no_pairs():
    rng = random.Random(2)
    made = {}
    for count in (100, 400):
        sets = [np.sort(np.array([hash(s) & (2**63 - 1) for s in shingles(t)], np.uint64))
                for t in template_texts(count, rng, (24, 24)).values()]
        n = np.array([len(x) for x in sets])
        made[count] = len(setsketch.prefix_pairs(np.concatenate(sets), n, np.arange(count), np.zeros(count, np.int64))[0])
    assert made == {100: 0, 400: 0}


def test_near_misses_and_links_of_one_template(spark, monkeypatch):
    rng = random.Random(7)
    texts = template_texts(140, rng, (18, 24))
    for d in range(140, 170):                                   # some are close to one of them
        w = texts[rng.randrange(140)].split()
        w[rng.randrange(len(w))] = f"new{d}"
        texts[d] = " ".join(w)
    want = brute_components(texts)
    assert 100 < len(set(want.values())) < 170
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    for block, volume in ((1024, 1 << 20), (1024, 2000)):
        monkeypatch.setattr(setsketch, "BLOCK", block)
        monkeypatch.setattr(setsketch, "BLOCK_SHINGLES", volume)
        assert {r.doc_id: r.component_id for r in setsketch.near_duplicates(df).collect()} == want
