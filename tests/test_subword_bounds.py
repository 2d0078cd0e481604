"""Subword work in bounded slices: what a tokenizer is called with, every row
decoded by its own ids, and pieces remembered by use."""
import random

import pytest

from kiln.operators import subwords as sw
from kiln.operators import text as tx
from kiln.plans.q_subwords import VOCABULARY


@pytest.fixture(scope="module")
def subwords(spark):
    return sw.subword_tokenizer(spark, VOCABULARY)


@pytest.fixture
def lengths():
    def run(texts):
        """One token a text, its length; refuses more than two slices of text."""
        if len(texts) > 1 and sum(map(len, texts)) > 2 << 20:
            raise MemoryError("called with too much text at a time")
        return [([len(t)], [0], [len(t)]) for t in texts]
    return run


def _texts(spark):
    rows = [(i, None if i % 50 == 7 else "ab " * (i % 2000), "é" * (i % 5)) for i in range(4000)] + [(4000, "x" * (3 << 20), "z")]
    return rows, spark.createDataFrame(rows, "id long, a string, b string").coalesce(1)


@pytest.mark.parametrize("spans", [False, True])
def test_a_tokenizer_gets_bounded_slices(spark, lengths, spans):
    rows, df = _texts(spark)
    got = sw.encoded(df, {"x": "a", "y": "b"}, lengths, spans=spans, keep=["id"])
    assert got.columns == (["id", "x", "x_spans", "y", "y_spans"] if spans else ["id", "x", "y"])
    assert sorted((r.id, r.x, r.y) for r in got.collect()) == [(i, None if a is None else [len(a)], [len(b)]) for i, a, b in rows]


def test_chunks_through_a_tokenizer_in_slices(spark, lengths):
    rows, df = _texts(spark)
    got = tx.chunk(df, "id", "a", "b", max_len=5, overlap=2, tokenizer=lengths, with_spans=True)
    assert sorted((r.sample_id, r.input_ids[:2], r.offset_end) for r in got.collect()) == [
        (i, [len(a), len(b)], [len(a), len(b)]) for i, a, b in rows if a is not None]


def test_rows_are_decoded_by_their_own_ids(spark, subwords):
    rows = [(1, "one two three"), (1, "four"), (None, "no key"), (2, None), (3, ""), (4, "été " * 300_000)]
    df = spark.createDataFrame(rows, "id long, text string").coalesce(1)
    ids = sw.encoded(df, {"ids": "text"}, subwords, keep=["id"])
    back = sw.decoded(ids, ["id"], "ids", sw.read_vocabulary(spark, VOCABULARY))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)
    assert "Exchange" not in back._jdf.queryExecution().executedPlan().toString().split("Scan")[0]


def test_an_unknown_id_fails(spark):
    df = spark.createDataFrame([(1, [5, -1])], "id long, ids array<bigint>")
    with pytest.raises(Exception, match="an id is not in the vocabulary"):
        sw.decoded(df, ["id"], "ids", sw.read_vocabulary(spark, VOCABULARY)).collect()


def test_ids_alone_are_those_with_spans(subwords):
    rng = random.Random(1)
    texts = ["", "é" * 200, "ab" * 300] + ["".join(rng.choice("abcé日 '\n1,") for _ in range(rng.randint(0, 90))) for _ in range(400)]
    assert subwords.ids(texts) == [list(e[0]) for e in subwords(texts)]
    for n in range(0, 200, 3):
        piece = bytes(rng.choice(b"abcdeth \xc3\xa9") for _ in range(n))
        assert subwords._merge_short(piece) == subwords._merge_long(piece)


def test_frequent_pieces_stay_remembered(subwords, monkeypatch):
    monkeypatch.setattr(sw, "MEMO_PIECES", 20)
    fresh, merged = sw.Subwords(subwords.ranks), []
    monkeypatch.setattr(fresh, "merge", lambda p: merged.append(p) or subwords.merge(p))
    fresh([" the" + " x" + "a" * (i % 50) for i in range(400)])
    assert merged.count(b" the") == 1
