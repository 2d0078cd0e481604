import hashlib
import random
import zlib

from kiln.llm import prefix_trie


def brute(rows):
    """(conv_id, turn, role, text) rows -> nodes, by dictionaries."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(x)] for c, x in convs.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        paths[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(p[:d], []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    out = []
    for p, m in members.items():
        below = [x for x in members if x[:len(p)] == p]
        ends = ",".join(str(c) for c in sorted(m) if len(paths[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])),
                    sum(x not in kids for x in below), sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows, more=()):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, level string")
    return sorted(map(tuple, prefix_trie.conversation_trie(df).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=repr)


def test_random_conversations(spark):
    rng = random.Random(5)
    rows = []
    for c in list(range(0, 40)) + [100, 101, 205, 317, -5, -100, -117, 10 ** 12 + 7]:
        for t in range(rng.choice([1, 1, 2, 3, 8, 9, 17, 25])):
            rows.append((c, t, rng.choice(["user", "bot"]), rng.choice(["a", "bb", "é\U0001F600"])))
    assert found(spark, rows) == brute(rows)


def test_nulls_ties_repeats_and_turnless(spark):
    rows = [(None, 0, "user", "lost"), (0, None, "user", "first"), (0, 3, None, None), (0, 3, None, None), (0, 3, "bot", "tie"),
            (1, 0, "user", "x"), (2, 0, "user", "x"), (7, 0, "user", "y"), (8, 5, "user", ""), (200, 1, "", "z"), (203, 1, "u", "only")]
    assert found(spark, rows) == brute(rows)


def test_one_long_conversation_and_many_copies(spark):
    rows = [(300, t, "user", f"turn {t % 7}") for t in range(700)]             # a large share of all rows, 88 blocks
    rows += [(c, t, "user", f"same {t}") for c in range(400, 700) for t in range(3)]
    rows += [(301, t, "user", f"turn {t % 7}") for t in range(650)]
    assert found(spark, rows) == brute(rows)


def test_pieces_of_a_large_node(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_BITS", 2)
    rows = [(c, 0, "user", "hello") for c in range(-9, 120)]
    assert found(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert found(spark, []) == []
