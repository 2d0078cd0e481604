"""Syncmer fingerprints: edited texts, context-free anchors, likeness."""
import hashlib
import random

import numpy as np
from llm_helpers import prose

from kiln.llm import syncmers


def cps(text):
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def brute_edit(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, (d, t) in enumerate(rows):
        t, nxt = t or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    return sorted(out, key=str)


def test_edited_texts(spark, docs, no_docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for n in (1, 5):
        got = syncmers.fingerprints(docs.repartition(n)).collect()
        assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in got], key=str) == brute_edit(rows)
    assert syncmers.fingerprints(no_docs).count() == 0
    one = syncmers.fingerprints(docs.where("doc_id = 13")).first()
    assert (one.doc_id, one.n_chars, one.edited_sha256) == brute_edit([r for r in rows if r[0] == 13])[0]
    assert one.near_next == 1.0


def test_stray_ids_and_equal_texts(spark):
    rng = random.Random(1)
    rows = [(rng.choice([i, -i, i * 10**12, 2**62 + i]), prose(i % 9, 40)) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = syncmers.fingerprints(df).collect()
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in got], key=str) == brute_edit(rows)
    text = dict(rows)
    prints = {}
    for r in got:
        prints.setdefault(text[r.doc_id], set()).add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert all(len(p) == 1 for p in prints.values()) and len({min(p) for p in prints.values()}) == 9


def test_closed_syncmers_by_definition():
    text = "".join(random.Random(3).choice("abcdefgh é") for _ in range(400))
    pos, h = syncmers.syncmers(cps(text))
    from kiln.llm.textops import span_hashes
    want = []
    for i in range(len(text) - syncmers.K + 1):
        inner = [int(span_hashes(cps(text), np.array([j]), np.array([j + syncmers.S]))[0])
                 for j in range(i, i + syncmers.K - syncmers.S + 1)]
        if min(inner) in (inner[0], inner[-1]):
            want.append(i)
    assert pos.tolist() == want
    gaps = np.diff(pos)
    assert gaps.max() <= syncmers.K - syncmers.S + 1          # the window guarantee
    shifted, hs = syncmers.syncmers(cps("XYZ" + text))        # anchors do not depend on what is around
    moved = dict(zip((shifted - 3).tolist(), hs.tolist()))
    assert all(moved[p] == x for p, x in zip(pos.tolist(), h.tolist()))


def test_short_texts():
    assert syncmers.syncmers(cps(""))[0].tolist() == [] and syncmers.syncmers(cps("ab"))[0].tolist() == [0]
    assert syncmers.likeness(syncmers.text_fingerprint(cps("")), syncmers.text_fingerprint(cps(""))) == 1.0
    assert syncmers.likeness(syncmers.text_fingerprint(cps("")), syncmers.text_fingerprint(cps("ab"))) == 0.0


def test_likeness_follows_overlap():
    a, b = prose(11, 600), prose(12, 600)
    f = lambda t: syncmers.text_fingerprint(cps(t))
    assert syncmers.likeness(f(a), f(a)) == 1 and syncmers.likeness(f(a), f(b)) < 0.1
    assert 0.3 < syncmers.likeness(f(a), f(a[:len(a) // 2] + b[:len(b) // 2])) < 0.7


def test_anchors(docs):
    rows = syncmers.anchors(docs).where("doc_id in (2, 5, 6, 8)").collect()
    assert {r.doc_id for r in rows} == {2, 8}
    text = {r.doc_id: r.text for r in docs.where("doc_id in (2, 8)").collect()}
    for d in (2, 8):
        pos, h = syncmers.text_anchors(cps(text[d]))
        assert [(r.pos, r.anchor) for r in rows if r.doc_id == d] == list(zip(pos.tolist(), h.view(np.int64).tolist()))


def test_likeness_from_all_anchors_in_order(spark):
    rng = random.Random(6)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    alike = lambda a, b: syncmers.likeness(syncmers.text_fingerprint(cps(a)), syncmers.text_fingerprint(cps(b)))
    # a text's first half is found again at every length
    for n in (1, 2, 3, 7, 8, 15, 16, 20, 30, 31, 50, 63, 64, 200, 511, 512, 2000):
        t = letters(n)
        assert alike(t, t) == 1 and alike(t, t[:n - n // 2] + "0" * (n // 2)) > 0.2
        assert alike(t, t[:n - n // 2]) > 0.2
    # a common passage of 1 % in long texts is always found
    for _ in range(5):
        passage = letters(600)
        assert 0.005 < alike(letters(30000) + passage + letters(30000), letters(10000) + passage + letters(50000)) < 0.02
    # the same parts in another order are less alike
    parts = [letters(400) for _ in range(8)]
    assert alike("".join(parts), "".join(reversed(parts))) < 0.2
    assert alike("ab" * 30000, "ab" * 20000) > 0.7
    rows = [(i, letters(24)) for i in range(30)]
    got = syncmers.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert min(r.near_edited for r in got) > 0.2


def test_near_columns_come_from_the_printed_fingerprints(spark, docs):
    rows = [(i, prose(i % 13, 3 + 17 * (i % 9))) for i in range(80)] + [(80, None), (81, ""), (82, "é")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(syncmers.fingerprints(df).collect(), key=lambda r: r.doc_id)
    for i, r in enumerate(got):
        mine, edited = syncmers.unpack(r.fingerprint), syncmers.unpack(r.edited_fingerprint)
        assert r.near_edited == syncmers.likeness(mine, edited)
        assert r.near_next == syncmers.likeness(mine, syncmers.unpack(got[(i + 1) % len(got)].fingerprint))
        assert (r.fingerprint == "") == (r.n_chars == 0)


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y else max(row[j], before[j + 1])
    return row[-1]


def test_likeness_against_longest_common_subsequence():
    rng = random.Random(8)
    for trial in range(200):
        a = np.array(rng.sample(range(60), rng.randrange(1, 40)), np.uint32) << 3
        b = np.array(rng.sample(range(60), rng.randrange(1, 40)), np.uint32) << 3
        assert syncmers.likeness(a, b) == 2 * longest_common(a.tolist(), b.tolist()) / (len(a) + len(b))
        a, b = (np.array([rng.randrange(6) for _ in range(30)], np.uint32) << 3 for _ in range(2))      # with repeats: a bound
        assert syncmers.likeness(a, b) <= 2 * longest_common(a.tolist(), b.tolist()) / 60
        assert syncmers.likeness(a, b) == syncmers.likeness(b, a)


def test_one_rule_at_every_length():
    rng = random.Random(9)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    alike = lambda a, b: syncmers.likeness(syncmers.text_fingerprint(cps(a)), syncmers.text_fingerprint(cps(b)))
    mean = []
    for n in range(1, 90):
        mean.append(np.mean([alike(letters(n), letters(n)) for _ in range(60)]))
    assert max(mean) < 0.16 and max(abs(x - y) for x, y in zip(mean[4:], mean[5:])) < 0.06
    assert max(mean[40:]) < 0.02
    for text in (letters(1), letters(5), letters(11), letters(12), letters(13), letters(300)):
        words = syncmers.text_fingerprint(cps(text))
        pos, _ = syncmers.syncmers(np.concatenate([syncmers.BOUNDARY, cps(text)]), syncmers.K - syncmers.S)
        assert syncmers.positions(words).tolist() == pos.tolist() and len(words) >= min(len(text), syncmers.K - syncmers.S)
        assert np.diff(pos).max(initial=0) <= syncmers.K - syncmers.S + 1
        assert syncmers.pack(words) and (syncmers.unpack(syncmers.pack(words)) == words).all()
