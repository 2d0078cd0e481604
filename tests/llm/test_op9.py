"""Phrase index against brute force over words."""
import hashlib
import random

import pytest
from llm_helpers import prose, words
from pyspark.sql import functions as F

from kiln.llm import phrase_index

PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute(docs, items):
    wins = {}
    for i, t in items:
        w = words(t, PATTERN)
        for a in range(max(1, len(w) - 9) if w and i is not None else 0):
            wins.setdefault(tuple(w[a:a + 10]), set()).add(str(i))
    out = []
    for d, t in docs:
        w, hit, ids = words(t, PATTERN), set(), set()
        for n in {len(x) for x in wins}:
            for a in range(len(w) - n + 1):
                if (found := wins.get(tuple(w[a:a + n]))):
                    hit |= set(range(a, a + n))
                    ids |= found
        out.append((d, len(w), len(hit), len(ids), ",".join(sorted(ids)), bool(hit)))
    return sorted(out, key=str)


def run(docs, items):
    got = phrase_index.contamination(docs, items)
    return sorted([(r.doc_id, r.n_words, r.n_hit, r.n_items, ",".join(r["items"]), r.contaminated) for r in got.collect()],
                  key=str)


def test_random_texts(spark):
    rng = random.Random(6)
    items = [(i, " ".join(rng.choice("the of a b c d e".split()) if rng.random() < 0.5 else f"u{rng.randrange(60)}"
                          for _ in range(rng.choice([3, 9, 10, 11, 25])))) for i in range(20)]
    items += [(20, "x x x x x x x x x x x"), (21, "Solo"), (22, ""), (23, None), (None, prose(4, 15)), (24, items[3][1]),
              (24, items[3][1]), (25, "Ünïcode É " * 6)]
    docs = []
    for d in range(90):
        w = [f"u{rng.randrange(60)}" if rng.random() < 0.7 else "the" for _ in range(rng.randrange(0, 60))]
        for _ in range(rng.randrange(0, 3)):
            t = (rng.choice(items)[1] or "").split()
            a = rng.randrange(0, len(t) + 1)
            w[len(w) // 2:len(w) // 2] = t if rng.random() < 0.6 else t[:a]
        docs.append((d, rng.choice([" ", "  ", "-", ".\n"]).join(w).title() if d % 2 else "," + " ".join(w) + "!"))
    docs += [(200, None), (201, ""), (202, "x " * 30), (203, "solo"), (204, "ünïcode é ünïcode é ünïcode é ünïcode é ünïcode é"),
             (205, "ÜNÏCODE É " * 6), (None, "solo"), (206, "ünïcode É " * 5)]
    # rows of one id, and rows without one, are judged by their own texts
    docs += [(300, items[4][1]), (300, "three clean words"), (300, items[4][1]), (300, None), (None, items[5][1]), (None, "clean"), (None, None)]
    df = spark.createDataFrame([(d, t, 1, "z") for d, t in docs], "doc_id long, text string, start int, term string").repartition(4)
    it = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, n int")
    assert run(df, it) == brute(docs, items)


def test_edge_cases(spark, docs, no_docs):
    items = spark.createDataFrame([(1, "one two three"), (2, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11")], "item_id long, text string")
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    assert run(docs, items) == brute(plain, [tuple(r) for r in items.collect()])
    assert phrase_index.contamination(no_docs, items).count() == 0
    assert {r.contaminated for r in phrase_index.contamination(docs, items.limit(0)).collect()} == {False}


def test_uncontaminated_keeps_rows_and_columns(spark):
    rows = [(1, "a b", "x"), (1, "solo", "y"), (None, "solo one", "z"), (None, "clean", None), (2, None, "w"), (1, "a b", "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _row_id string")
    items = spark.createDataFrame([(1, "Solo")], "item_id long, text string")
    got = phrase_index.uncontaminated(df.withColumnRenamed("_row_id", "extra"), items)
    assert got.columns == ["doc_id", "text", "extra"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted([r for r in rows if "solo" not in (r[1] or "")], key=str)


def test_proximity(spark):
    rng = random.Random(8)
    docs = [(d, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(0, 40)))) for d in range(40)]
    queries = [(1, ["a", "b"]), (2, ["c", "d", "e"]), (3, ["zz", "a"]), (4, ["f"]), (5, ["g", "g", "h"])]
    got = {(r.query_id, r.doc_id, r["first"], r["last"]) for r in phrase_index.proximity_matches(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(queries, "query_id long, terms array<string>"), 5).collect()}
    want = set()
    for q, terms in queries:
        for d, t in docs:
            w, spans = t.split(), {}
            for a, x in enumerate(w):
                if x in terms:
                    last = [next((p for p in range(a, min(len(w), a + 5)) if w[p] == y), None) for y in set(terms)]
                    if None not in last:
                        spans[max(last)] = max(a, spans.get(max(last), -1))
            want |= {(q, d, a, b) for b, a in spans.items()}
    assert got == want


def test_plans_have_no_python(spark, docs):
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    out = phrase_index.contamination(docs, items).withColumn("h", F.sha2(F.concat_ws(",", "items").cast("binary"), 256))
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert out.where("doc_id = 13").first().h == hashlib.sha256(b"").hexdigest()


def test_ascii_lower_only(spark):
    df = spark.createDataFrame([("ÀBC İ ΣΑΣ",), ("ABC",), (None,)], "t string")
    assert [r[0] for r in df.select(phrase_index.lower_ascii(F.col("t"))).collect()] == ["Àbc İ ΣΑΣ", "abc", None]


@pytest.mark.parametrize("text,want", [("", 0), (None, 0), ("a-b", 2), (" x ", 1), ("é1é", 1), ("---", 0)])
def test_word_count(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(phrase_index.word_count(F.col("t"))).first()[0] == want
