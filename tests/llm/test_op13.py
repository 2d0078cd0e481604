import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from kiln.llm import runs
from llm_helpers import LONG


def brute_runs(w, least=2):
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        x = 0
        while x < n - q:
            s = x
            while x < n - q and w[x] == w[x + q]:
                x += 1
            if x - s >= q:
                found.setdefault((s, x + q), q)
            x += 1
    return sorted((a, b, q) for (a, b), q in found.items() if b - a >= least)


def brute(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if n and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    found = sorted(((a, b - a, q) for a, b, q in brute_runs(w) if b - a >= max(12, 2 * q)), key=lambda r: (r[0], r[2]))
    gone = {i for a, size, q in found for i in range(a + q, a + size)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    listed = "".join(f"{a},{size},{q}\n" for a, size, q in found)
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def sequence(rng):
    n, kind = rng.randint(2, 300), rng.randrange(7)
    if kind == 0:
        return [rng.randint(0, 1) for _ in range(n)]
    if kind == 1:                                                  # Fibonacci words
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    if kind == 2:                                                  # repeated blocks of many sizes
        out = []
        while len(out) < n:
            block = [rng.randint(0, rng.choice([1, 2, 5, 50])) for _ in range(rng.choice([1, 2, 7, 17, 33, 70]))]
            out += (block * rng.randint(1, 5))[:rng.randint(1, len(block) * 5)]
        return out[:n]
    if kind == 3:                                                  # many runs around one break
        return [0, 1] * rng.randint(20, 80) + [1, 0] * rng.randint(20, 80)
    if kind == 4:                                                  # Thue-Morse: hardest for rolling hashes
        s = [0]
        while len(s) < n:
            s = s + [1 - x for x in s]
        return s[:n]
    if kind == 5:                                                  # periodic blocks inside periods
        u = ([0, 1, 0] * rng.randint(10, 30))[:rng.randint(17, 60)]
        return (u + u[:-1] + [2]) * rng.randint(1, 3) + u[:rng.randint(0, len(u))]
    block = [0] * rng.randint(15, 60) + [1]
    return block * rng.randint(2, 4) + block[:rng.randint(0, len(block))]


@pytest.mark.parametrize("seed", range(4))
def test_find_runs_is_complete(seed):
    rng = random.Random(seed)
    for _ in range(150):
        w = sequence(rng)
        assert [tuple(r) for r in runs.find_runs(np.array(w, np.uint64)).tolist()] == sorted(brute_runs(w), key=lambda r: (r[0], r[2], r[1]))


def test_long_thue_morse_has_no_false_run():
    s = np.zeros(1, np.uint64)
    while len(s) < 1 << 13:
        s = np.concatenate([s, 1 - s])
    got = runs.find_runs(s)
    assert ((got[:, 1] - got[:, 0]) <= 4 * got[:, 2]).all()
    for a, b, q in got.tolist():
        assert np.array_equal(s[a:b - q], s[a + q:b])


def test_documents_against_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        vocab = rng.choice([3, 40, 1000])
        words = [f"w{rng.randrange(vocab)}é" for _ in range(rng.randint(0, 260))]
        if rng.random() < 0.5 and words:
            at, size = rng.randrange(len(words)), rng.randint(1, 60)
            words[at:at] = words[at:at + size] * rng.randint(2, 6)
        rows.append((i, rng.choice([" ", "\n", "\t  "]).join(words)))
    rows += [(1, None), (2, ""), (None, "a b " * 9), (3, " \n "), (4, "x " * 40), (4, "x " * 40), (5, "one two three"), (20, "a b c d e f")]
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id long, text string, n_runs int, h string").repartition(5)
    got = sorted(map(tuple, runs.periodic_runs(df).collect()), key=repr)
    assert got == sorted((brute(*r) for r in rows), key=repr)


def test_long_text_and_empty_table(spark, no_docs):
    text = LONG + " " + "z9 " * 50
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = runs.periodic_runs(df).first()
    assert (row.n_runs, row.start, row.length, row.period) == (2, 0, 20_000, 977)
    assert runs.periodic_runs(no_docs).count() == 0


def test_planted_repetition_is_found(spark):
    rows = [(i, " ".join(f"u{i}x{j}" for j in range(200))) for i in range(60)]
    got = {r.doc_id: r for r in runs.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, _ in rows:
        h = zlib.crc32(str(i).encode())
        a, p = (h // 10) % 200, 1 + (200 - (h // 10) % 200) // (3 + h // 10 % 8)
        planted = h % 10 == 0 and 200 - a >= max(12, 2 * p)
        assert got[i].n_runs == int(planted)
        if planted:
            assert (got[i].start, got[i].length, got[i].period) == (a, 200 - a, p)
