"""Subword tokens against an independent implementation, round trips, and a
caller's own tokenizer."""
import base64
import random

import pytest
from pyspark.sql import functions as F

from kiln.operators import subwords as sw
from kiln.operators import text as tx
from kiln.plans.q_subwords import VOCABULARY

TEXTS = ["Hello  world, it's 2024!\n\n  indented\t\ttabs ", "été à la plage \U0001F600\U0001F1EB\U0001F1F7 öl", "日本語のテキスト 한국어 العربية", "",
         "   ", "a" * 5000, "ab" * 3000 + "  x", "it's they'll I'd 'S", "\x00\x01 control\r\n", "ﬁ ǆ ß ſ K", "x" + "́" * 200]


@pytest.fixture(scope="module")
def subwords(spark):
    return sw.subword_tokenizer(spark, VOCABULARY)


def test_ids_equal_an_independent_tokenizer(subwords):
    tiktoken = pytest.importorskip("tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}
    other = tiktoken.Encoding("t", pat_str=sw.PIECE_PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(0)
    alphabet = "abc ABC  é\U0001F600日\n\t'st1.,"
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(500)]
    assert [list(e[0]) for e in subwords(texts)] == [other.encode_ordinary(t) for t in texts]


def test_spans_cover_the_text_and_spell_the_tokens(subwords):
    tokens = {i: t for t, i in subwords.ranks.items()}
    for text, (ids, starts, ends) in zip(TEXTS, subwords(TEXTS)):
        assert b"".join(tokens[i] for i in ids).decode() == text
        at = 0
        for i, s, e in zip(ids, starts, ends):
            assert s <= at <= e or s == at          # a split character is spanned whole by each part
            at = max(at, e)
            raw = text[s:e].encode()
            assert tokens[i] == raw or (len(tokens[i]) < len(raw) and tokens[i] in raw)
        assert at == len(text)


def test_round_trip_in_spark(spark, subwords):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(99, None), (100, TEXTS[0])]
    df = spark.createDataFrame(rows, "id long, text string").repartition(3)
    ids = sw.encoded(df, {"ids": "text"}, subwords).select("id", "ids")
    back = sw.decoded(ids, ["id"], "ids", sw.read_vocabulary(spark, VOCABULARY))
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_two_columns_spans_and_empty_table(spark, subwords):
    df = spark.createDataFrame([(1, "one two", "three"), (2, None, "x"), (3, "", None)], "id long, a string, b string")
    got = {r.id: r for r in sw.encoded(df, {"x": "a", "y": "b"}, subwords, spans=True).collect()}
    assert got[1].x_spans.ends == [3, 7] and len(got[1].y) == len(got[1].y_spans.starts)
    assert got[2].x is None and got[2].x_spans.starts is None and got[3].x == [] and got[3].y is None
    empty = sw.encoded(df.limit(0), {"x": "a"}, subwords)
    assert empty.columns == ["id", "a", "b", "x"] and empty.count() == 0


def test_vocabularies_that_cannot_be_used(spark, subwords, monkeypatch):
    with pytest.raises(ValueError, match="single bytes"):
        sw.Subwords({b"a": 0})
    monkeypatch.setattr(sw, "MAX_VOCABULARY_BYTES", 1000)
    with pytest.raises(ValueError, match="over 1000"):
        sw.subword_tokenizer(spark, VOCABULARY)


def test_chunks_of_a_callers_tokenizer(spark):
    def letters(texts):
        """One token a character, its id the code point."""
        return [([ord(c) for c in t], range(len(t)), range(1, len(t) + 1)) for t in texts]

    df = spark.createDataFrame([(1, "abcdefgh", "Z"), (2, None, "Z"), (3, "abc", "toolonganswer"), (4, "", "Z")], "id long, p string, a string")
    got = sorted(tx.chunk(df, "id", "p", "a", max_len=5, overlap=2, tokenizer=letters, with_spans=True, pad_id=-1).collect())
    assert [(r.sample_id, r.chunk_index, "".join(map(chr, r.input_ids[:r.n_real])), r.offset_start) for r in got] == [
        (1, 0, "abcdZ", [0, 1, 2, 3, 0]), (1, 1, "cdefZ", [2, 3, 4, 5, 0]), (1, 2, "efghZ", [4, 5, 6, 7, 0]), (4, 0, "Z", [0])]
    assert got[3].input_ids == [ord("Z"), -1, -1, -1, -1]
    out = sorted(map(tuple, tx.rejected_rows(df, "id", "p", "a", 5, 2, tokenizer=letters).collect()))
    assert out == [(2, "no prompt"), (3, "answer too long")]
    assert tx.chunk(df.where(F.lit(False)), "id", "p", "a", tokenizer=letters).count() == 0
